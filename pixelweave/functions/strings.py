"""Name, formula and field functions as column expressions, and natural-sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of replacements that conform metabolite names, (Java pattern, replacement).
GREEK = [("alpha", "a"), ("beta", "b"), ("gamma", "g"), ("delta", "d"), ("epsilon", "e"), ("zeta", "z"), ("eta", "h")]
DIGIT_LETTERS = {"1": "a", "2": "b", "3": "g", "4": "d", "5": "e", "6": "z", "7": "h"}
ACIDS = [
    (r"\bacids\b", "acid"), (r"acids*,(.*)ic$", "$1ic acid"), ("anoic", "yric"), (r"anoate\b", "yrate"), (r"ic acids*\b", "ate"), (r"ates\b", "ate"),
]
L_NAMES = "alanine arginine asparagine cysteine glutamine glycine histidine isoleucine leucine lysine methionine phenylalanine proline serine threonine tryptophan tyrosine valine".split()
L_LATER = r"aspartate\b|glutamate\b|cysteinylglycine|homocysteine|norleucine|selenomethionine|anserine|homoserine|allothreonine|norvaline"
SPELLING = [
    ("sulph", "sulf"), (r"sulfid\b", "sulfide"), (r"\bl-(" + L_LATER + ")", "$1"), ("thane", "thyl"), (r"mono(\S)", "$1"), (r"\(\+/-\)", "(+-)"),
    (r"(?<!\w)(d|l|dl)-*\((\+|-|\+-)\)(?!\w)", "$1"), (r"(?<!\w)\((\+|-|\+-)\)-*(d|l|dl)(?!\w)", "$2"),
]
#: Characters with a plain equivalent; what NFKD can't split.
ASCII_FROM = "αβγδεζηθικλμνξοπρστυφχψωßøłđ‐‑‒–—−′’“”×·"
ASCII_TO = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu", "xi", "omicron", "pi", "rho", "sigma", "tau", "upsilon", "phi", "chi", "psi", "omega", "ss", "o", "l", "d", "-", "-", "-", "-", "-", "-", "'", "'", '"', '"', "x", "."]
ACCENTS = ("àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY")


def _chain(x: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        x = F.regexp_replace(x, pattern, to)
    return x


def to_ascii(x: Column) -> Column:
    """Accents off, Greek letters spelled out, dashes and quotes plain; other characters above 127 dropped."""
    x = F.translate(x, *ACCENTS)
    for a, b in zip(ASCII_FROM, ASCII_TO, strict=True):
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.regexp_replace(x, r"[^\x00-\x7F]", "")


def hyphens(x: Column) -> Column:
    """Hyphens only as signs (beside a bracket) and between digits; other marks but commas and plus signs go, and of these
    and of signs one of a row stays. A name is cut at its signs, so that the parts between need no look at them."""
    other = r"[^,+\w]"

    def clean(part: Column) -> Column:
        kept = F.regexp_replace(part, rf"(?<![0-9]){other}++|{other}++(?![0-9])", "")
        return F.regexp_replace(F.regexp_replace(kept, other, "-"), r"([,+])\1+", "$1")

    parts = F.split(x, r"[(\[{]-|-[)\]}]", -1)
    return F.regexp_replace(F.array_join(F.transform(parts, clean), "-"), "--+", "-")


def conform_name(name: Column) -> Column:
    """A name in the form in which synonyms meet: lower case, plain characters, folded Greek letters and numbers,
    acids as -ate, no L- of amino acids, hyphens only between digits, and the half of a name that is twice the same."""
    x = to_ascii(F.lower(name))
    x = _chain(x, [("_", " "), (r" +\([^0-9()]+\)$", "")])
    x = _chain(x, [(f"(?<![A-Za-z]){a}(?![A-Za-z])", b) for a, b in GREEK])
    x = _chain(x, [(rf"\b{a}\b", b) for a, b in DIGIT_LETTERS.items()])
    x = _chain(x, ACIDS)
    x = F.regexp_replace(x, r"\bl-(" + "|".join([*L_NAMES, "aspartic acid", "glutamic acid"]) + ")", "$1")
    x = hyphens(_chain(x, SPELLING))
    half = (F.length(x) / 2).cast("int")
    twice = (F.length(x) % 2 == 0) & (F.length(x) > 0) & (F.substr(x, F.lit(1), half) == F.substr(x, half + 1, half))
    return F.when(twice, F.substr(x, F.lit(1), half)).otherwise(x)


def natural_key(x: Column) -> Column:
    """A sort key in which runs of digits compare as numbers (up to 20 digits)."""
    padded = F.regexp_replace(x, "([0-9]+)", "00000000000000000000$1")
    return F.regexp_replace(padded, "0*([0-9]{20})(?![0-9])", "$1")


def is_number(x: Column) -> Column:
    """A finite number, also with separators of thousands."""
    return F.trim(x).rlike(r"^[+-]?(([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$")


def to_number(x: Column) -> Column:
    return F.when(is_number(x), F.regexp_replace(F.trim(x), ",", "").try_cast("double"))


def is_all_digits(x: Column) -> Column:
    return x.rlike("^[0-9]+$")


def decode_entities(x: Column) -> Column:
    """The five XML entities, the ampersand last."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def unquote(x: Column) -> Column:
    """Outer spaces and one pair of outer quotes off, doubled quotes single."""
    x = F.trim(x)
    x = F.when(x.rlike('^".*"$') & (F.length(x) > 1), F.substr(x, F.lit(2), F.length(x) - 2)).otherwise(x)
    return F.replace(x, F.lit('""'), F.lit('"'))


def newick_name(x: Column) -> Column:
    """Characters that Newick reserves as hyphens."""
    return F.translate(x, "()[]{}:;,'\" \t", "-" * 13)


# --- formulas ---------------------------------------------------------------------------------------------------------------

ELEMENT = r"([A-Z][a-z]?)([0-9]*)"


def formula_counts(formula: Column) -> Column:
    """Map element -> count; null if an element is repeated or anything else stands in the formula."""
    names = F.regexp_extract_all(formula, F.lit(ELEMENT), F.lit(1))
    counts = F.transform(F.regexp_extract_all(formula, F.lit(ELEMENT), F.lit(2)), lambda n: F.when(n == "", 1).otherwise(n.try_cast("int")))
    good = formula.rlike(f"^({ELEMENT})+$") & (F.size(F.array_distinct(names)) == F.size(names))
    return F.when(good, F.map_from_arrays(names, counts))


def hill_formula(counts: Column) -> Column:
    """Hill order: with carbon C, H, then the alphabet; else the alphabet. Counts of 1 aren't written, 0 left out."""
    rank = lambda e: F.when(F.map_contains_key(counts, F.lit("C")) & e.isin("C"), "0").when(F.map_contains_key(counts, F.lit("C")) & e.isin("H"), "1").otherwise(F.concat(F.lit("2"), e))
    own = F.filter(F.map_entries(counts), lambda e: e["value"] > 0)
    keyed = F.array_sort(F.transform(own, lambda e: F.struct(rank(e["key"]).alias("r"), e["key"].alias("k"), e["value"].alias("v"))))
    return F.array_join(F.transform(keyed, lambda e: F.concat(e["k"], F.when(e["v"] == 1, "").otherwise(e["v"].cast("string")))), "")


ADDUCT_ATOMS = {"[M+H]+": ("H", 1), "[M+Na]+": ("Na", 1), "[M+K]+": ("K", 1), "[M-H]-": ("H", -1), "[M+Cl]-": ("Cl", 1)}


def conform_formula(formula: Column, adduct: str | None = None) -> Column:
    """A formula in Hill order, with the adduct's atom added or taken off; null if it can't be read or would go below 0."""
    counts = formula_counts(F.regexp_replace(formula, r"\s", ""))
    if adduct:
        atom, n = ADDUCT_ATOMS[adduct]
        new = F.coalesce(F.try_element_at(counts, F.lit(atom)), F.lit(0)) + n
        rest = F.map_filter(counts, lambda k, _: k != atom)
        counts = F.when(new >= 0, F.map_concat(rest, F.create_map(F.lit(atom), new)))
    return hill_formula(counts)


def only_common_elements(formula: Column) -> Column:
    """Only S, P, O, N, C and H."""
    return formula.rlike("^([SPONCH][0-9]*)+$")
