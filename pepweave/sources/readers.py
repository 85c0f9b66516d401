"""Typed scans of search results, feature tables, scorer output and weights."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import SCORER, SEARCH, SIDES

#: Fixed value: a spectrum id is raw file, scan, modified sequence and charge, joined by dashes.
SPEC_ID = r"^(.+?)-\d+-.+-\d+$"


def number(c: Column, kind: str = "double") -> Column:
    """A number from any text, null where there is none; whole numbers go through double, as '2.0' is one."""
    d = c.cast("string").try_cast("double")
    d = F.when(F.isnan(d), None).otherwise(d)
    return d if kind == "double" else d.try_cast(kind)


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes null in all floating columns, so that null is the only missing marker."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(F.isnan(F.col(f"`{c}`")), None).otherwise(F.col(f"`{c}`")) for c in floats})


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(p)) if "*" in path else fs.exists(p)


def files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(x.getPath().toString() for x in found or ())


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_search(spark: SparkSession, path: str, side: str) -> DataFrame:
    """All raw files of a branch in one scan: a folder or glob of comma-separated files with a header; columns by name, extras ignored."""
    schema = SEARCH[side]
    path = path if "*" in path else f"{path.rstrip('/')}/*.rescore"
    if not exists(spark, path):
        return empty(spark, schema)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}

    def typed(name: str) -> Column:
        if name not in raw.columns:
            return F.lit(None).cast(kinds[name])
        c, kind = F.col(name), kinds[name]
        return F.nullif(c, F.lit("")) if kind == "string" else c.try_cast("boolean") if kind == "boolean" else number(c, kind)

    return raw.select(*(typed(f.name).alias(f.name) for f in schema.fields))


# checked scans: what can't be read or typed goes to an error table, by raw file and with the reason

ERRORS = "source string, RAW_FILE string, reason string, n long, example string"
#: Texts that stand for a missing number.
MISSING = ("", "nan", "na", "n/a", "null", "none")


def stem(path: Column) -> Column:
    """The raw file that a search file is named after, from its path as Spark gives it."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.coalesce(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))), name)


def mistyped(c: Column, kind: str = "double") -> Column:
    """Whether a text is there, stands for no missing value and is no number (or truth value)."""
    text = F.lower(F.trim(c.cast("string")))
    typed = c.try_cast("boolean") if kind == "boolean" else number(c, kind)
    return F.coalesce(~text.isin(*MISSING) & typed.isNull(), F.lit(False))


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Of each file that is not empty the first line. The files are read as text once; the driver gets a line a file."""

    def heads(batches):
        seen = set()
        for pdf in batches:
            new = pdf.drop_duplicates("path")
            new = new[~new["path"].isin(seen)]
            seen.update(new["path"])
            yield new

    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
    found = lines.where("at = 0").select("path", "value").mapInPandas(heads, "path string, value string")
    return {r.path: r.value for r in found.collect()}


def _torn_csv(spark: SparkSession, paths: list[str] | str, names: list[str], sep: str) -> DataFrame:
    """All rows as text, with __torn (the line, where it has more or fewer fields than the header) and __path."""
    schema = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("__torn", T.StringType())])
    reader = spark.read.schema(schema).options(header=True, sep=sep, mode="PERMISSIVE", columnNameOfCorruptRecord="__torn", columnPruning=False)
    return reader.csv(paths).withColumn("__path", F.col("_metadata.file_path"))


def _reasons(checks: dict[str, Column]) -> Column:
    """The first reason that holds, or null."""
    out = None
    for reason, c in checks.items():
        out = F.when(c, F.lit(reason)) if out is None else out.when(c, F.lit(reason))
    return out


def errors_of(rows: DataFrame, source: str) -> DataFrame:
    """rows: RAW_FILE, __reason and __line (an example). A row of ERRORS for each raw file and reason."""
    bad = rows.where("__reason is not null")
    return bad.groupBy("RAW_FILE", F.col("__reason").alias("reason")).agg(F.count("*").alias("n"), F.min("__line").alias("example")).select(F.lit(source).alias("source"), "RAW_FILE", "reason", "n", "example")


def read_search_checked(spark: SparkSession, path: str, side: str, keep) -> tuple[DataFrame, DataFrame]:
    """Like read_search, and the errors: files without a row or header, torn rows, and scan numbers or truth values that are none.

    Files are grouped by header, so columns go by name in each. keep writes a table once and reads it back, as errors and rows are both taken from it."""
    schema, source = SEARCH[side], f"{side} search"
    paths = files(spark, path if "*" in path else f"{path.rstrip('/')}/*.rescore")
    if not paths:
        return empty(spark, schema), spark.createDataFrame([], ERRORS)
    heads = {_plain(p): line for p, line in first_lines(spark, [_literal(p) for p in paths]).items()}
    groups: dict[tuple[str, ...], list[str]] = {}
    unread = [(p, "empty file") for p in paths if _plain(p) not in heads]
    for p in paths:
        line = heads.get(_plain(p))
        if line is None:
            continue
        names = tuple(x.strip().strip('"').removeprefix("\ufeff") for x in line.split(","))
        if {"SCAN_NUMBER", "SEQUENCE"} <= set(names) and len(set(names)) == len(names):
            groups.setdefault(names, []).append(_literal(p))
        else:
            unread.append((p, "no header"))
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}
    out = None
    for names, own in sorted(groups.items()):
        raw = _torn_csv(spark, own, list(names), ",")

        def typed(name: str, names=names) -> Column:
            if name not in names:
                return F.lit(None).cast(kinds[name])
            c, kind = F.col(f"`{name}`"), kinds[name]
            return F.nullif(c, F.lit("")) if kind == "string" else c.try_cast("boolean") if kind == "boolean" else number(c, kind)

        checks = {"torn row": F.col("__torn").isNotNull()}
        checks |= {f"mistyped {n}": mistyped(F.col(n), kinds[n]) for n in ("SCAN_NUMBER", "REVERSE") if n in names}
        line = F.coalesce("__torn", F.concat_ws(",", *(F.coalesce(f"`{n}`", F.lit("")) for n in names)))
        rows = raw.select(*(typed(f.name).alias(f.name) for f in schema.fields), stem(F.col("__path")).alias("__stem"), _reasons(checks).alias("__reason"), F.substring(line, 1, 200).alias("__line"))
        rows = rows.withColumn("__line", F.when(F.col("__reason").isNotNull(), F.col("__line")))
        out = rows if out is None else out.unionByName(rows)
    lost = spark.createDataFrame([(p, r) for p, r in unread], "path string, reason string").select(F.lit(source).alias("source"), stem(F.col("path")).alias("RAW_FILE"), "reason", F.lit(0).cast("long").alias("n"), F.lit(None).cast("string").alias("example"))
    if out is None:
        return empty(spark, schema), lost
    held = keep(out, f"search-{side}")
    return held.drop("__stem", "__reason", "__line"), errors_of(held.withColumn("RAW_FILE", F.col("__stem")), source).unionByName(lost)


def _plain(path: str) -> str:
    """A path in one spelling: those that Spark gives with a row are percent-encoded, and slashes after the scheme differ."""
    return re.sub(r"^(\w+:)/*", r"\1/", unquote(path))


def _literal(path: str) -> str:
    """A path in which nothing is a pattern."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", path)


def read_features_checked(spark: SparkSession, path: str, source: str, keep) -> tuple[DataFrame, DataFrame]:
    """Like read_features, and the errors: torn rows, and labels or features that are no numbers, by the raw file that the id names."""
    names = spark.read.option("header", True).option("sep", "\t").csv(path).columns
    raw, text = _torn_csv(spark, path, names, "\t"), {"Peptide", "Proteins", "SpecId"}
    checks = {"torn row": F.col("__torn").isNotNull()}
    checks |= {f"mistyped {n}": mistyped(F.col(f"`{n}`")) for n in names if n not in text}

    def typed(n: str) -> Column:
        return F.col(f"`{n}`") if n in text else number(F.col(f"`{n}`"), "int" if n == "Label" else "double")

    line = F.substring(F.coalesce("__torn", "SpecId"), 1, 200)
    rows = raw.select(*(typed(n).alias(n) for n in names), _reasons(checks).alias("__reason"), line.alias("__line")).withColumn("RAW_FILE", raw_file_of(F.col("SpecId")))
    held = keep(rows.where("RAW_FILE is not null or __reason is not null"), source.replace(" ", "-"))
    return held.where("RAW_FILE is not null").drop("__reason", "__line"), errors_of(held, source)


def read_scores_checked(spark: SparkSession, target: str | None, decoy: str | None, source: str, keep) -> tuple[DataFrame, DataFrame]:
    """Like read_scores, and the errors: torn rows and scores that are no numbers, by the raw file that the id names."""
    found = None
    for path, is_target in ((target, True), (decoy, False)):
        if path and exists(spark, path):
            names = spark.read.option("header", True).option("sep", "\t").csv(path).columns
            raw = _torn_csv(spark, path, names, "\t")
            checks = {"torn row": F.col("__torn").isNotNull(), "mistyped score": mistyped(F.col("score"))}
            cols = [F.col("PSMId"), *(number(F.col(f"`{c}`")).alias(c) for c in SCORER.names[1:])]
            rows = raw.select(*cols, F.lit(is_target).alias("is_target"), _reasons(checks).alias("__reason"), F.substring(F.coalesce("__torn", "PSMId"), 1, 200).alias("__line"))
            found = rows if found is None else found.unionByName(rows)
    if found is None:
        return empty(spark, SCORER).withColumn("is_target", F.lit(True)), spark.createDataFrame([], ERRORS)
    held = keep(found.withColumn("RAW_FILE", raw_file_of(F.col("PSMId"))), source.replace(" ", "-"))
    return held.where("RAW_FILE is not null").drop("RAW_FILE", "__reason", "__line"), errors_of(held, source)


def raw_file_of(spec_id: Column) -> Column:
    return F.nullif(F.regexp_extract(spec_id, SPEC_ID, 1), F.lit(""))


def read_features(spark: SparkSession, path: str, with_raw_file: bool = True) -> DataFrame:
    """The feature table: tab-separated, SpecId and Label, all other columns doubles whatever they are called; rows whose id names no raw file go."""
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    typed = {"SpecId": F.col("SpecId"), "Label": number(F.col("Label"), "int")} if "Label" in raw.columns else {"SpecId": F.col("SpecId")}
    text = {"Peptide", "Proteins"}
    out = raw.select(*(typed.get(c, F.col(f"`{c}`") if c in text else number(F.col(f"`{c}`"))).alias(c) for c in raw.columns))
    out = out.withColumn("RAW_FILE", raw_file_of(F.col("SpecId"))).where(F.col("RAW_FILE").isNotNull())
    return out if with_raw_file else out.drop("RAW_FILE")


def read_scores(spark: SparkSession, target: str | None, decoy: str | None = None) -> DataFrame:
    """Scorer output of target and decoy files that exist, with is_target."""
    found = empty(spark, SCORER).withColumn("is_target", F.lit(True))
    for path, is_target in ((target, True), (decoy, False)):
        if path and exists(spark, path):
            raw = spark.read.option("header", True).option("sep", "\t").csv(path)
            cols = [F.col("PSMId"), *(number(F.col(f"`{c}`")).alias(c) for c in SCORER.names[1:])]
            found = found.unionByName(raw.select(*cols).withColumn("is_target", F.lit(is_target)))
    return found.where(raw_file_of(F.col("PSMId")).isNotNull())


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet dataset with only some columns; without the path an empty frame of the schema."""
    if not exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        df = empty(spark, schema)
    else:
        df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.select(*columns) if columns else df


def read_by_raw_file(spark: SparkSession, path: str) -> DataFrame:
    """A dataset with a folder for each raw file; names stay text, as '001' is not 1."""
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.parquet(path)  # the schema is settled here
    finally:
        spark.conf.set(key, before)


def raw_files(*branches: DataFrame, first: int | None = None) -> DataFrame:
    """Names of the raw files of all branches, in order, or the first few of them."""
    names = None
    for b in branches:
        own = b.select("RAW_FILE").where(F.col("RAW_FILE").isNotNull())
        names = own if names is None else names.union(own)
    names = names.distinct().orderBy("RAW_FILE")
    return names if first is None else names.limit(first)


def only_raw_files(df: DataFrame, names: DataFrame) -> DataFrame:
    return df.join(names, "RAW_FILE", "left_semi")


def other_side(side: str) -> str:
    return SIDES[1 - SIDES.index(side)]


def parse_weights(lines: list[str]) -> tuple[list[str], list[list[float]], list[list[float]]]:
    """Header, normalised and raw weights of each bin, from blocks of three lines; comments and blank lines are skipped."""
    rows = [x.strip().split("\t") for x in lines if x.strip() and not x.startswith("#")]
    if len(rows) % 3:
        raise ValueError("weights come in blocks of three lines")
    blocks = [rows[k : k + 3] for k in range(0, len(rows), 3)]
    return (blocks[-1][0] if blocks else []), [[float(x) for x in b[1]] for b in blocks], [[float(x) for x in b[2]] for b in blocks]


def average_weights(bins: list[list[float]]) -> list[float]:
    return [sum(x) / len(bins) for x in zip(*bins, strict=False)]
