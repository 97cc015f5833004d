"""Personal data by regular expressions, checksums and context words, with built-in functions only.

Each kind has a pattern whose matches are found leftmost and without overlap: splitting at the pattern gives what stands
between matches, so positions are running sums of lengths in code points. Validators confirm matches (parts of an IP,
Luhn, digits of a phone number, mod 97); words near a match, as far as the next match of its kind, raise its score. The
base kinds stay whatever their score; the added kinds (iban, ssn) need the least score.

Texts of any length are taken whole. Patterns begin only where a run of their characters begins and repeat groups
possessively, so that no match recurses and a text is read a bounded number of times. Running sums go over blocks of
BLOCK matches, then over the blocks, and pieces are cut by their bytes, so that time grows with the text and with the
matches; only one number a block of matches is appended to an array that grows.

Null and empty texts have no spans. Repeated rows are kept; extra columns are ignored by reports and kept by masking;
an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_SCORE = 0.6
CONTEXT_CHARS = 40
#: Matches whose running sums are built as one array.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str
    context: str
    score: float
    base: bool = True


KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "@", r"(?i)mail|contact|write", 0.9),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", r"(?i)\bip\b|address|host|server", 0.6),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", "", r"(?i)card|visa|pay|credit", 0.8),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", r"(?i)phone|tel|call|mobile", 0.7),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])", "", r"(?i)iban|account|bank|transfer", 0.7, False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", r"(?i)ssn|social|security|tax", 0.4, False),
]


def bind(x: Column, f) -> Column:
    """f(x) with x evaluated once."""
    return F.element_at(F.transform(F.array(x), f), 1)


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether a string of digits passes: from the right, every second digit is doubled, less 9 above 9."""
    places = F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(c == "", 0).otherwise(bind(c.cast("int") * (1 + i % 2), lambda v: F.when(v > 9, v - 9).otherwise(v))))
    return F.aggregate(places, F.lit(0), lambda s, x: s + x) % 10 == 0


def mod97(x: Column) -> Column:
    """Whether an IBAN's check holds: the first four characters last, letters as 10 to 35, remainder 1."""
    turned = F.concat(F.substr(x, F.lit(5)), F.substring(x, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), lambda s, c: (s * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97) == 1


def confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, "\\."), lambda p: bind(F.regexp_replace(p, "^0+(?=.)", ""), lambda q: (F.length(q) <= 3) & (F.lpad(q, 3, "0") <= "255")))
    if kind == "card":
        return bind(digits(m), lambda d: F.length(d).between(13, 19) & luhn(d))
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    if kind == "iban":
        return bind(F.replace(m, F.lit(" "), F.lit("")), lambda x: F.length(x).between(15, 34) & mod97(x))
    return F.lit(True)


def running(xs: Column, zero: Column, add) -> Column:
    """For an array, the state before each element: ``zero``, then ``add`` of the state and each element's state. ``add``
    must be associative."""

    def before(block: Column, first: Column) -> Column:
        none = F.array().cast("array<struct<a:int,b:int>>")
        step = lambda s, x: F.struct(add(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(block, F.struct(first.alias("at"), none.alias("out")), step)["out"]

    def whole(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, zero, add))
        return F.flatten(F.zip_with(blocks, before(totals, zero), before))

    count = F.greatest(F.lit(1), F.ceil(F.size(xs) / BLOCK)).cast("int")
    return bind(F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.slice(xs, k * BLOCK + 1, F.lit(BLOCK))), whole)


def pair(a: Column, b: Column) -> Column:
    return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))


#: Places in code points, and in bytes.
SPAN = "struct<start:int,end:int,kind:string,score:double,from:int,to:int>"


def spans_of(text: Column, kind: Kind) -> Column:
    """Array of confirmed spans of one kind: start, end (exclusive, code points), kind, score, from, to (bytes)."""
    none = F.array().cast(f"array<{SPAN}>")
    lit = F.lit(kind.pattern)

    def located(matches: Column) -> Column:
        def place(pieces: Column) -> Column:
            size = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda p, m: pair(F.length(p) + F.length(m), F.octet_length(p) + F.octet_length(m)))
            at = bind(size, lambda x: running(x, pair(F.lit(0), F.lit(0)), lambda s, y: pair(s["a"] + y["a"], s["b"] + y["b"])))

            def span(z: Column) -> Column:
                p, m, after, at = z["p"], z["m"], z["after"], z["at"]
                start, begin = at["a"] + F.length(p), at["b"] + F.octet_length(p)
                near = F.concat_ws("", F.right(p, F.lit(CONTEXT_CHARS)), m, F.left(after, F.lit(CONTEXT_CHARS)))
                score = F.least(F.lit(1.0), F.lit(kind.score) + F.when(near.rlike(kind.context), 0.3).otherwise(0.0))
                return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), F.lit(kind.name).alias("kind"), score.alias("score"), begin.alias("from"), (begin + F.octet_length(m)).alias("to"))

            whole = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("p"), matches.alias("m"), F.slice(pieces, 2, F.size(matches)).alias("after"), at.alias("at"))
            named = F.transform(whole, lambda z: F.struct(z["p"].alias("p"), z["m"].alias("m"), z["after"].alias("after"), z["at"].alias("at")))
            return F.transform(F.filter(named, lambda z: confirmed(kind.name, z["m"])), span)

        return F.when(F.size(matches) == 0, none).otherwise(bind(F.split(text, kind.pattern, -1), place))

    found = bind(F.regexp_extract_all(text, lit, F.lit(0)), located)
    found = F.when(F.contains(text, F.lit(kind.needs)), found).otherwise(none) if kind.needs else found
    return found if kind.base else F.filter(found, lambda x: x["score"] >= LEAST_SCORE)


def with_spans(docs: DataFrame, out: str = "pw_spans") -> DataFrame:
    """A struct column of one array of spans for each kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(out, F.struct(*(spans_of(text, k).alias(k.name) for k in KINDS)))


def joined(spans: list[Column]) -> Column:
    return F.array_join(F.flatten(F.array(*(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))) for s in spans))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans, digest of these, all spans, and their scores in the same order."""
    own = with_spans(docs.select(F.col("doc_id").cast("long"), "text")).select("doc_id", "pw_spans")
    of = {k.name: F.col("pw_spans")[k.name] for k in KINDS}
    scores = F.array_join(F.flatten(F.array(*(F.transform(x, lambda y: F.format_number(y["score"], 1)) for x in of.values()))), ",")
    return own.select(
        "doc_id", *(F.size(of[k.name]).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base),
        F.sha2(joined([of[k.name] for k in KINDS if k.base]), 256).alias("base_sha256"), joined(list(of.values())).alias("spans"), scores.alias("scores"),
    )


def masked(text: Column, spans: Column) -> Column:
    """Text with its spans (sorted: from, -to, kind) replaced. A span that begins before an earlier one's end names nothing,
    but its text goes too."""

    def cut(raw: Column, own: Column, reach: Column) -> Column:
        piece = lambda a, b: F.substr(raw, a + 1, b - a).cast("string")
        both = F.zip_with(own, reach, lambda x, r: F.struct(x["from"].alias("from"), x["kind"].alias("kind"), r["a"].alias("reach")))
        put = F.transform(F.filter(both, lambda x: x["from"] >= x["reach"]), lambda x: F.concat(piece(x["reach"], x["from"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
        end = F.aggregate(own, F.lit(0), lambda s, x: F.greatest(s, -x["back"]))
        return F.concat(F.array_join(put, ""), piece(end, F.length(raw)))

    ends = F.transform(spans, lambda x: pair(-x["back"], F.lit(0)))
    reach = bind(ends, lambda x: running(x, pair(F.lit(0), F.lit(0)), lambda s, y: pair(F.greatest(s["a"], y["a"]), F.lit(0))))
    return bind(text.cast("binary"), lambda raw: bind(reach, lambda r: cut(raw, spans, r)))


def mask(docs: DataFrame) -> DataFrame:
    """Texts with each span replaced by its kind in brackets; of overlapping spans the first, then the longest, names it.

    Columns stay as they are; n_chars follows the text where there is such a column. Null texts stay null.
    """
    every = F.sort_array(F.flatten(F.array(*(F.transform(F.col("pw_spans")[k.name], lambda x: F.struct(x["from"].alias("from"), (-x["to"]).alias("back"), x["kind"].alias("kind"))) for k in KINDS))))
    new = F.when(F.size("pw_all") > 0, masked(F.col("text"), F.col("pw_all"))).otherwise(F.col("text"))
    own = with_spans(docs).withColumn("pw_all", every).withColumn("text", new).drop("pw_all", "pw_spans")
    return own.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else own


def op9_pii(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return pii_report(table(spark, sf_dir, "documents"))
