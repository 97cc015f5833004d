"""Readers and writers of matrices, pixel tables, distances, weights, libraries and spectra.

Text tables are read as strings and cast with try_cast, so that blank and non-numeric cells are null. Wide matrices
become long at once: the number of pixels never is the width of a plan beyond the scan.
"""

from __future__ import annotations

import io
import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.strings import decode_entities, to_number, unquote
from ..model import pixel_x, pixel_y
from . import imzml


def _text(spark: SparkSession, path: str, sep: str = "\t", header: bool = True, comment: str | None = None) -> DataFrame:
    r = spark.read.option("sep", sep).option("header", header).option("inferSchema", False).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    return (r.option("comment", comment) if comment else r).csv(path)


def number_or_null(c: Column) -> Column:
    v = F.trim(c).try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


# --- matrices and pixels -----------------------------------------------------------------------------------------------------------------


def read_matrix(spark: SparkSession, *paths: str) -> DataFrame:
    """Wide tab-separated matrices (first column: feature) as one long one; files add columns to the same features.

    Rows that are shorter than the header have missing cells (null); blank header cells are left out. Zstandard and gzip
    files are read as they are.
    """
    out = None
    for path in paths:
        wide = _text(spark, path)
        first, *rest = wide.columns
        rest = [c for c in rest if c and not re.fullmatch(r"_c\d+", c)]
        long = wide.where(F.trim(F.col(f"`{first}`")) != "").unpivot(F.col(f"`{first}`").alias("feature"), [F.col(f"`{c}`") for c in rest], "pixel_id", "cell")
        long = long.select(F.col("feature"), "pixel_id", number_or_null(F.col("cell")).alias("intensity"))
        out = long if out is None else out.unionByName(long)
    return out


SEVEN = ["Pixel", "X", "Y", "tree order", "cluster", "cluster_size", "color"]


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """A pixel-cluster table in the app's columns: the seven known headers, or the first four columns by place."""
    t = _text(spark, path)
    a, x, y, c = ("Pixel", "X", "Y", "cluster") if t.columns[:7] == SEVEN else t.columns[:4]
    color = F.col("color") if "color" in t.columns else F.concat(F.lit("x"), F.upper(F.substring(F.md5(F.concat(F.lit("12345:"), F.col(f"`{c}`")).cast("binary")), 1, 6)))
    own = t.select(F.col(f"`{a}`").alias("pixel_id"), F.col(f"`{x}`").try_cast("int").alias("x_coord"), F.col(f"`{y}`").try_cast("int").alias("y_coord"), F.col(f"`{c}`").alias("hc_orig"), color.alias("color"))
    from ..operators.selection import numbered

    rows = numbered(own, "row_id", "y_coord", "x_coord", "pixel_id")
    return rows.select(F.col("row_id").cast("int"), "pixel_id", "x_coord", "y_coord", "hc_orig", F.lit("Default").alias("hc_manual"), F.lit("Default").alias("mz_manual"), "color")


def read_pipeline_pixels(spark: SparkSession, path: str) -> DataFrame:
    """A pipeline's own cluster table: Pixel, X, Y, cluster by name, else the first four columns."""
    t = _text(spark, path)
    names = ["Pixel", "X", "Y", "cluster"]
    if not set(names) <= set(t.columns):
        if len(t.columns) < 4:
            raise ValueError("four columns are needed")
        t = t.toDF(*names, *t.columns[4:])
    return t.select(F.col("Pixel").alias("pixel_id"), F.col("X").try_cast("int").alias("x_coord"), F.col("Y").try_cast("int").alias("y_coord"), F.col("cluster").alias("hc_orig"))


def pixels_of_names(m: DataFrame) -> DataFrame:
    """Coordinates from the pixel names of a matrix, -1 where a name has none."""
    return m.select("pixel_id").distinct().select("pixel_id", pixel_x(F.col("pixel_id")).alias("x_coord"), pixel_y(F.col("pixel_id")).alias("y_coord"))


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """name, weight of rows whose weight is a number."""
    t = _text(spark, path)
    a, b = t.columns[:2]
    return t.select(F.col(f"`{a}`").alias("name"), number_or_null(F.col(f"`{b}`")).alias("weight")).where("weight is not null")


def weighted(names: DataFrame, weights: DataFrame) -> DataFrame:
    """Names with their weight, 1 where none is given."""
    return names.join(weights, "name", "left").select("name", F.coalesce("weight", F.lit(1.0)).alias("weight"))


def read_distances(spark: SparkSession, path: str) -> DataFrame:
    """A labelled lower triangle as the edge list (i, j, dist), j before i in the file; the diagonal is dropped."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.split("value", "\t").alias("c"))
    n = lines.select(F.get("c", F.lit(0)).alias("name"), F.size("c").alias("k"), F.slice("c", 2, 1 << 30).alias("d"))
    order = n.select((F.col("k") - 1).alias("pos"), "name")  # row k has k cells
    cells = n.select(F.col("name").alias("i"), F.posexplode("d").alias("at", "v"), F.col("k")).where("at < k - 2")
    return cells.join(order.select((F.col("pos") - 1).alias("at"), F.col("name").alias("j")), "at").select("i", "j", number_or_null(F.col("v")).alias("dist"))


def read_metabolites(spark: SparkSession, path: str) -> DataFrame:
    t = _text(spark, path, ",")
    if missing := [c for c in ("metabolite_id", "metabolite_name", "mass", "pathway") if c not in t.columns]:
        raise ValueError(f"columns missing: {missing}")
    return t.select("metabolite_id", "metabolite_name", F.col("mass").try_cast("double").alias("mass"), "pathway")


# --- library tables by header patterns ------------------------------------------------------------------------------------------------------

HEADERS = {
    "mz": r"(?i)^m/?z$", "ccs": r"(?i)^ccs( \[.*\])?$", "mass": r"(?i)(mono|exact)[ _]?(isotopic )?mass|neutral mass", "name": r"(?i)^(chosen_)?name$", "inchi": r"(?i)^inchi$",
    "kegg": r"(?i)kegg", "cid": r"(?i)pubchem|cid", "hmdb": r"(?i)hmdb|accession", "formula": r"(?i)formula", "charge": r"(?i)formal_charge", "notation": r"(?i)^notation|adduct", "mol_id": r"(?i)^(lm_id|accession)$",
}


def bind_headers(t: DataFrame, wanted: dict[str, str] = HEADERS, last: bool = False) -> dict[str, str]:
    """Column of each field whose header matches, the first one (or the last)."""
    out = {}
    for field, pattern in wanted.items():
        found = [c for c in t.columns if re.search(pattern, c.strip())]
        if found:
            out[field] = found[-1 if last else 0]
    return out


def read_library(spark: SparkSession, path: str, source: str) -> DataFrame:
    """A molecule table with ``CCS: [adduct]`` columns; rows without a numeric mass are left out."""
    t = _text(spark, path, comment="#")
    at = bind_headers(t)
    text = lambda f: unquote(F.col(f"`{at[f]}`")) if f in at else F.lit(None).cast("string")
    ccs = [c for c in t.columns if c.startswith("CCS: ")]
    entries = F.filter(F.array(*(F.struct(F.lit(c[5:].strip()).alias("k"), to_number(F.col(f"`{c}`")).alias("v")) for c in ccs)), lambda e: e["v"].isNotNull()) if ccs else None
    own = t.select(
        text("mol_id").alias("mol_id"), F.lit(source).alias("source"), to_number(text("mass")).alias("mass"), text("charge").try_cast("int").alias("charge"), *(text(f).alias(f) for f in ("formula", "name", "inchi", "kegg", "cid", "hmdb")),
        (F.map_from_entries(entries) if ccs else F.create_map().cast("map<string,double>")).alias("ccs"),
    )
    return own.where("mass is not null")


def read_peaks(spark: SparkSession, path: str) -> DataFrame:
    """A vendor's peak export: mz, ccs, adduct; rows without a number for m/z are left out."""
    t = _text(spark, path, comment="#")
    at = bind_headers(t)
    get = lambda f: F.col(f"`{at[f]}`") if f in at else F.lit(None).cast("string")
    return t.select(to_number(get("mz")).alias("mz"), to_number(get("ccs")).alias("ccs"), unquote(get("notation")).alias("adduct")).where("mz is not null")


# --- HMDB XML, LipidMaps SDF, CSV variants ---------------------------------------------------------------------------------------------------


def read_hmdb(spark: SparkSession, path: str, tag: str = "metabolite") -> DataFrame:
    """Top-level text fields of each record, entities decoded; a name of digits only gives way to an IUPAC name."""
    t = spark.read.format("xml").option("rowTag", tag).load(path)
    kinds = dict(t.dtypes)
    fields = ["accession", "name", "traditional_iupac", "iupac_name", "chemical_formula", "inchi", "kegg_id", "pubchem_compound_id", "monisotopic_molecular_weight"]
    get = lambda c: decode_entities(F.col(c).cast("string")) if c in kinds else F.lit(None).cast("string")
    own = t.select(*(get(c).alias(c) for c in fields))
    return own.withColumn("name", F.when(F.col("name").rlike("^[0-9]+$"), F.coalesce("traditional_iupac", "iupac_name", "name")).otherwise(F.col("name")))


def read_sdf(spark: SparkSession, path: str) -> DataFrame:
    """Records of ``> <KEY>`` blocks: LM_ID, fields as a map, CHOSEN_NAME (the shorter of NAME and SYSTEMATIC_NAME, else
    the finest class) and the isotope mark of ``[isoN]``."""
    blocks = spark.read.option("lineSep", "$$$$").text(path).where(F.col("value").rlike(r"\S"))
    keys = F.regexp_extract_all("value", F.lit(r"> <([^>]+)>\r?\n([^\r\n]*)"), F.lit(1))
    vals = F.transform(F.regexp_extract_all("value", F.lit(r"> <([^>]+)>\r?\n([^\r\n]*)"), F.lit(2)), lambda v: F.replace(F.trim(v), F.lit(" / "), F.lit("; ")))
    own = blocks.select(F.map_from_entries(F.array_distinct(F.arrays_zip(keys.alias("k"), vals.alias("v")))).alias("f"))
    f = lambda k: F.nullif(F.try_element_at("f", F.lit(k)), F.lit(""))
    a, b = f("NAME"), f("SYSTEMATIC_NAME")
    chosen = F.when(a.isNotNull() & b.isNotNull(), F.when(F.length(b) < F.length(a), b).otherwise(a)).otherwise(F.coalesce(a, b, f("SUB_CLASS"), f("MAIN_CLASS"), f("CATEGORY")))
    iso = r"\s*\[iso([0-9]+)\]"
    return own.select(f("LM_ID").alias("LM_ID"), F.trim(F.regexp_replace(chosen, iso, "")).alias("CHOSEN_NAME"), F.nullif(F.regexp_extract(chosen, iso, 1), F.lit("")).alias("ISO"), f("EXACT_MASS").try_cast("double").alias("EXACT_MASS"), f("FORMULA").alias("FORMULA"), F.col("f").alias("fields"))


def read_csv(spark: SparkSession, path: str, semicolon: bool = False, unwrap: bool = False) -> DataFrame:
    """Quoted comma or semicolon tables with doubled quotes and line breaks within quotes (made blanks by unwrap)."""
    t = spark.read.option("sep", ";" if semicolon else ",").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).option("mode", "PERMISSIVE").csv(path)
    return t.select(*(F.regexp_replace(F.col(f"`{c}`"), r"\s*\r?\n\s*", " ").alias(c) for c in t.columns)) if unwrap else t


def repair_fields(fields: Column, at: int) -> Column:
    """Fields of a row in which those from ``at`` to the next number belong together: joined by ``;``."""
    tail = F.slice(fields, at + 1, 1 << 30)
    first = F.array_position(F.transform(tail, lambda x: x.try_cast("double").isNotNull()), True)  # 1: as it should not be
    glued = F.concat(F.slice(fields, 1, at), F.array(F.array_join(F.slice(tail, 1, F.greatest(first - 1, F.lit(1)).cast("int")), ";")), F.slice(tail, F.greatest(first, F.lit(2)).cast("int"), 1 << 30))
    return F.when(first > 2, glued).otherwise(fields)


# --- imzML --------------------------------------------------------------------------------------------------------------------------------------


def read_imzml(spark: SparkSession, path: str) -> DataFrame:
    """x, y, mz and intensity arrays of the spectra of ``<path>.imzML`` and ``<path>.ibd``: by ranges where these are files
    to the driver, and so to the executors; else whole, in one row of bytes, which bounds the .ibd by 2 GB."""
    if imzml.is_file(path):
        imzml.register(spark)
        return spark.read.format("imzml").load(imzml.local_path(path))
    both = spark.read.format("binaryFile").load([f"{path}.imzML", f"{path}.ibd"]).select(F.regexp_extract("path", r"([^/]+)\.[^.]+$", 1).alias("stem"), F.col("path").endswith(".ibd").alias("is_ibd"), "content")

    def decode(df: pd.DataFrame) -> pd.DataFrame:
        xml, ibd = df[~df.is_ibd].content.iloc[0], df[df.is_ibd].content.iloc[0]
        array = lambda offset, length, kind: imzml.decoded(ibd[offset : offset + length * np.dtype(kind).itemsize], kind)
        rows = [(s.x, s.y, array(*s.mz), array(*s.intensity)) for s in imzml.spectra(io.BytesIO(xml))]
        return pd.DataFrame(rows, columns=["x", "y", "mz", "intensity"])

    return both.groupBy("stem").applyInPandas(decode, imzml.SCHEMA)


def pick_peaks(spectra: DataFrame, snr: float = 3.0) -> DataFrame:
    """x, y, mz, intensity of local maxima above snr times the spectrum's median, by array functions."""
    n = F.size("intensity")
    inner = F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1)))
    top = F.filter(inner, lambda i: (i < n - 1) & (F.get("intensity", i) > F.get("intensity", i - 1)) & (F.get("intensity", i) >= F.get("intensity", i + 1)) & (F.get("intensity", i) > snr * F.get(F.sort_array("intensity"), F.floor(n / 2).cast("int"))))
    return spectra.select("x", "y", F.explode(F.transform(top, lambda i: F.struct(F.get("mz", i).alias("mz"), F.get("intensity", i).alias("intensity")))).alias("p")).select("x", "y", "p.mz", "p.intensity")


def align_peaks(peaks: DataFrame, ppm: float = 10.0) -> DataFrame:
    """Peaks in bins of a ppm width on a logarithmic scale: feature named by the bin's mean m/z, sum a pixel.

    Neighbouring bins may split a peak at their border; equality with another picker isn't promised."""
    b = F.floor(F.ln("mz") / (ppm * 1e-6))
    own = peaks.withColumn("bin", b)
    center = own.groupBy("bin").agg(F.avg("mz").alias("center"))
    named = own.join(center, "bin").select(F.format_string("mz_%.4f", "center").alias("feature"), F.concat(F.lit("y"), F.col("y").cast("string"), F.lit("x"), F.col("x").cast("string")).alias("pixel_id"), "intensity")
    return named.groupBy("feature", "pixel_id").agg(F.sum("intensity").alias("intensity"))


def reference_peaks(peaks: DataFrame, ppm: float = 10.0) -> DataFrame:
    """Reference m/z values of a set of peaks, in order of m/z without a gap wider than the tolerance: feature, center, by
    the mean of each run. Bins of the tolerance's width are merged with their neighbour where the peaks at the border are
    nearer than the tolerance, so that none is split."""
    b = F.floor(F.ln("mz") / (ppm * 1e-6))
    bins = peaks.groupBy(b.alias("bin")).agg(F.min("mz").alias("low"), F.max("mz").alias("high"), F.sum("mz").alias("total"), F.count("*").alias("n"))
    # only bins that follow each other can touch: runs of consecutive bins are the groups within which borders are looked at
    w = Window.partitionBy(F.floor(F.col("bin") / 4096)).orderBy("bin")
    fresh = F.coalesce((F.col("low") - F.lag("high").over(w)) > F.col("low") * ppm * 1e-6, F.lit(True))
    runs = bins.withColumn("run", F.sum(fresh.cast("int")).over(w)).groupBy(F.floor(F.col("bin") / 4096).alias("part"), "run").agg((F.sum("total") / F.sum("n")).alias("center"))
    return runs.select(F.format_string("mz_%.4f", "center").alias("feature"), "center")


def fill_peaks(spectra: DataFrame, reference: DataFrame, ppm: float = 10.0) -> DataFrame:
    """The second pass: for each spectrum and reference m/z the largest intensity within the tolerance, whether it was
    picked as a peak or not. No row where a spectrum has no point there."""
    from ..operators.annotate import band_join

    points = spectra.select("x", "y", F.explode(F.arrays_zip("mz", "intensity")).alias("p")).select("x", "y", "p.mz", "p.intensity")
    near = band_join(points, reference.withColumn("mz_db", F.col("center")), ppm)
    pixel = F.concat(F.lit("y"), F.col("y").cast("string"), F.lit("x"), F.col("x").cast("string"))
    return near.groupBy("feature", pixel.alias("pixel_id")).agg(F.max("intensity").alias("intensity"))


def peak_process(spectra: DataFrame, snr: float = 3.0, ppm: float = 10.0) -> DataFrame:
    """Both passes: peaks are picked, their m/z values become the reference, and every spectrum is read there again."""
    return fill_peaks(spectra, reference_peaks(pick_peaks(spectra, snr), ppm), ppm)


# --- sinks -----------------------------------------------------------------------------------------------------------------------------------------


def general_text(c: Column, digits: int) -> Column:
    """Significant digits without zeros at the end of the fraction."""
    return F.regexp_replace(F.regexp_replace(F.format_string(f"%.{digits}g", c), r"(\.\d*?)0+($|e)", "$1$2"), r"\.($|e)", "$1")


def number_text(c: Column) -> Column:
    """The shorter of 14 significant digits and 6 decimals, blank for missing."""
    a, b = general_text(c, 14), F.format_string("%.6f", c)
    return F.when(c.isNull(), "").when(F.length(a) <= F.length(b), a).otherwise(b)


def write_tsv(df: DataFrame, path: str, sep: str = "\t") -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).option("emptyValue", "").csv(path)


def matrix_lines(m: DataFrame) -> DataFrame:
    """feature and its tab-separated cells over the sorted pixels: the wide matrix without a wide plan."""
    from ..operators.distance import dense

    cells = dense(m, number_text(F.col("intensity")), F.lit(""))
    return cells.select("feature", F.concat_ws("\t", F.col("feature"), F.array_join("values", "\t", "")).alias("line"))


def triangle_lines(d: DataFrame) -> DataFrame:
    """name and its line of the labelled lower triangle (names in order, 0 last)."""
    own = d.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", general_text(F.col("dist"), 13).alias("t")))).alias("v"))
    names = d.select(F.col("i").alias("name")).union(d.select("j")).distinct()
    full = names.join(own, names["name"] == own["i"], "left")
    return full.select("name", F.concat_ws("\t", F.col("name"), F.array_join(F.transform("v", lambda x: x["t"]), "\t"), F.lit("0")).alias("line"))


def pixel_cluster_rows(p: DataFrame, clusters: DataFrame) -> DataFrame:
    """Pixel, X, Y, tree order, cluster (three digits), cluster_size of clustered pixels (clusters: leaf, leaf_order,
    cluster, cluster_size)."""
    own = p.join(clusters, p["pixel_id"] == clusters["leaf"])
    return own.select(F.col("pixel_id").alias("Pixel"), F.col("x_coord").alias("X"), F.col("y_coord").alias("Y"), F.col("leaf_order").alias("tree order"), F.lpad(F.regexp_replace("cluster", "^C0*", ""), 3, "0").alias("cluster"), "cluster_size")


#: Headers of a mapping table in their order; fields that no record has are left out.
MAPPING = ["accession", "name", "chemical_formula", "monisotopic_molecular_weight", "iupac_name", "traditional_iupac", "inchi", "kegg_id", "pubchem_compound_id"]


def mapping_table(records: DataFrame) -> DataFrame:
    """One row an accession in order of accession, each field's distinct values in order, joined by |."""
    kept = [c for c in MAPPING if c in records.columns]
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.col(c) != "", F.col(c).cast("string")))), "|").alias(c)
    return records.where("accession is not null").groupBy("accession").agg(*(joined(c) for c in kept if c != "accession")).select(*kept)


def ccs_table(library: DataFrame, adducts: tuple[str, ...] = ("[M+H]+", "[M+Na]+", "[M-H]-")) -> DataFrame:
    """A library's columns, the formula chosen, and a ``CCS: adduct`` column for each adduct in order of name; no CCS of
    [M-H]- for a formula without hydrogen."""
    bare = (F.col("formula") != "") & ~F.col("formula").rlike("H(?![a-z])")
    value = lambda a: F.when(F.lit(a == "[M-H]-") & F.coalesce(bare, F.lit(False)), None).otherwise(F.try_element_at("ccs", F.lit(a)))
    return library.select(*(c for c in library.columns if c != "ccs"), F.col("formula").alias("formula_chosen"), *(value(a).alias(f"CCS: {a}") for a in sorted(adducts)))


def weight_rows(weights: DataFrame) -> DataFrame:
    """Leaf and Weight with 14 significant digits."""
    return weights.select(F.col("leaf").alias("Leaf"), general_text(F.col("weight"), 14).alias("Weight"))
