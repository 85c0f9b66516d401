"""Registered queries of the engine's own operators over the sample tables, and their DuckDB forms."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import residues
from ..operators import calls, ecdf, forest, merge, plotdata, rescore, similarity
from ..schemas import SIDES
from ..sources import readers, sinks
from . import views
from .session import shared_folder, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: Both branches and the scan table, for oracles.
_COLUMNS = "MODIFIED_SEQUENCE PRECURSOR_CHARGE MASS SCORE SEQUENCE REVERSE percolator_score f_discount f_tax f_price f_quantity ISO_scores".split()
_SIDES = ", ".join(f"{s[0]}.{c} AS {c}_{s[1]}" for c in _COLUMNS for s in (("d", "database"), ("n", "denovo")))
FIX = f"""
WITH db AS ({views.DATABASE}),
dn AS ({views.DENOVO}),
dbi AS (SELECT *, RAW_FILE || '-' || CAST(SCAN_NUMBER AS STRING) || '-' || MODIFIED_SEQUENCE || '-' || CAST(PRECURSOR_CHARGE AS STRING) AS SpecId FROM db),
dni AS (SELECT *, RAW_FILE || '-' || CAST(SCAN_NUMBER AS STRING) || '-' || MODIFIED_SEQUENCE || '-' || CAST(PRECURSOR_CHARGE AS STRING) AS SpecId FROM dn),
scans AS (
  SELECT coalesce(d.RAW_FILE, n.RAW_FILE) AS RAW_FILE, coalesce(d.SCAN_NUMBER, n.SCAN_NUMBER) AS SCAN_NUMBER, coalesce(d.SpecId, n.SpecId) AS SpecId,
         CASE WHEN d.RAW_FILE IS NULL THEN 'denovo_only' WHEN n.RAW_FILE IS NULL THEN 'database_only' ELSE 'shared' END AS _merge,
         d.Label AS Label_database, n.AA_SCORE AS AA_SCORE_denovo, {_SIDES},
         coalesce(d.SEQUENCE = n.SEQUENCE, false) AS unmodified_sequence_match, coalesce(d.MODIFIED_SEQUENCE = n.MODIFIED_SEQUENCE, false) AS modified_sequence_match,
         coalesce(d.PRECURSOR_CHARGE = n.PRECURSOR_CHARGE, false) AS precursor_charge_match,
         coalesce(d.MODIFIED_SEQUENCE = n.MODIFIED_SEQUENCE AND d.PRECURSOR_CHARGE = n.PRECURSOR_CHARGE, false) AS sequence_match
  FROM dbi d FULL OUTER JOIN dni n ON d.RAW_FILE IS NOT DISTINCT FROM n.RAW_FILE AND d.SCAN_NUMBER IS NOT DISTINCT FROM n.SCAN_NUMBER),
ref AS (SELECT s.side, CASE s.side WHEN 'database' THEN ISO_scores_database ELSE ISO_scores_denovo END AS v FROM scans, (VALUES ('database'), ('denovo')) s(side)
        WHERE _merge = 'shared' AND Label_database = 1 AND percolator_score_database > 0),
oth AS (SELECT CASE _merge WHEN 'database_only' THEN 'database' ELSE 'denovo' END AS side, coalesce(ISO_scores_database, ISO_scores_denovo) AS v FROM scans WHERE _merge <> 'shared'),
nn AS (SELECT side, count(*) FILTER (r = 1) AS n, count(*) FILTER (r = 0) AS m FROM (SELECT side, 1 AS r FROM ref UNION ALL SELECT side, 0 FROM oth) GROUP BY side),
steps AS (SELECT side, v, sum(a) OVER w AS a_le, sum(b) OVER w AS b_le, a FROM
  (SELECT side, v, sum(r) AS a, sum(1 - r) AS b FROM (SELECT side, v, 1 AS r FROM ref UNION ALL SELECT side, v, 0 FROM oth) GROUP BY side, v)
  WINDOW w AS (PARTITION BY side ORDER BY v)),
ks AS (SELECT side, n, m, v AS loc, abs(d) AS stat FROM (
  SELECT steps.side, n, m, v, a, a_le::DOUBLE / n - b_le::DOUBLE / m AS d,
         row_number() OVER (PARTITION BY steps.side ORDER BY abs(a_le::DOUBLE / n - b_le::DOUBLE / m) DESC, CASE WHEN a_le::DOUBLE / n - b_le::DOUBLE / m >= 0 THEN 1 ELSE 0 END DESC, CASE WHEN a > 0 THEN 1 ELSE 0 END DESC, v) AS k
  FROM steps JOIN nn ON nn.side = steps.side) WHERE k = 1)
"""


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def search(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    """A merged branch with its SpecId."""
    df = views.branch(spark, sf_dir, side)
    return df.withColumn("SpecId", C.spec_id(F.col("RAW_FILE"), F.col("SCAN_NUMBER"), F.col("MODIFIED_SEQUENCE"), F.col("PRECURSOR_CHARGE")))


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scan table. Ids are made of their parts after the merge, so that they don't go through its shuffles."""
    df = merge.scan_table(*(views.branch(spark, sf_dir, s) for s in SIDES))
    ids = {f"SpecId_{s}": F.when(C.on_side(s), C.spec_id(F.col("RAW_FILE"), F.col("SCAN_NUMBER"), F.col(f"MODIFIED_SEQUENCE_{s}"), F.col(f"PRECURSOR_CHARGE_{s}"))) for s in SIDES}
    return df.withColumns(ids).withColumn("SpecId", F.coalesce(*ids))


def populations(df: DataFrame) -> DataFrame:
    """Scores of both sides, those of trusted shared rows marked a and those of rows on one side b; df, a merge of whole tables, is read once."""
    rows = ecdf.marked_scores(df, dict.fromkeys(SIDES, C.trusted_shared()), {s: C.only_on(s) for s in SIDES})
    return rows.where("a > 0 or b > 0")


@query("branch_full_outer", FIX + "SELECT RAW_FILE, SCAN_NUMBER, SpecId, SEQUENCE_database, SEQUENCE_denovo, _merge AS found_by FROM scans")
def branch_full_outer(spark, sf_dir):
    out = merge.merge_scans(*(search(spark, sf_dir, s) for s in SIDES))
    return out.select("RAW_FILE", "SCAN_NUMBER", "SpecId", "SEQUENCE_database", "SEQUENCE_denovo", F.col("_merge").alias("found_by"))


_PIN = """, pin AS (SELECT SpecId || CASE WHEN SCAN_NUMBER % 3 = 0 THEN '-0' ELSE '' END AS SpecId, max(Label) AS Label, max(f_price) AS f_price, min(f_tax) AS f_tax FROM dbi GROUP BY 1),
sc AS (SELECT SpecId || CASE WHEN SCAN_NUMBER % 4 = 0 THEN '-0' ELSE '' END AS PSMId, percolator_score AS score, Label = 1 AS is_target FROM dbi),
one AS (SELECT PSMId, score FROM (SELECT *, row_number() OVER (PARTITION BY PSMId ORDER BY is_target DESC, score DESC) AS k FROM sc) WHERE k = 1)
"""


def _pin(spark, sf_dir):
    """Search rows, features and scores; ids of some features and scores are others, so that rows without a counterpart are on all sides."""

    def moved(every: int):
        return F.concat("SpecId", F.when(F.col("SCAN_NUMBER") % every == 0, "-0").otherwise(""))

    rows = search(spark, sf_dir, "database")
    pin = rows.groupBy(moved(3).alias("SpecId")).agg(F.max("Label").alias("Label"), F.max("f_price").alias("f_price"), F.min("f_tax").alias("f_tax"))
    scores = rows.select(moved(4).alias("PSMId"), F.col("percolator_score").alias("score"), (F.col("Label") == 1).alias("is_target"))
    return rows.select("RAW_FILE", "SCAN_NUMBER", "MODIFIED_SEQUENCE", "PRECURSOR_CHARGE", "SEQUENCE"), pin, scores


@query("pin_merge", FIX + _PIN + "SELECT coalesce(d.SpecId, p.SpecId) AS SpecId, d.RAW_FILE, d.SEQUENCE, p.Label, p.f_price, p.f_tax, CASE WHEN p.SpecId IS NOT NULL THEN one.score END AS percolator_score FROM dbi d FULL OUTER JOIN pin p ON d.SpecId = p.SpecId LEFT JOIN one ON one.PSMId = p.SpecId")
def pin_merge(spark, sf_dir):
    rows, pin, scores = _pin(spark, sf_dir)
    return merge.merge_branch(rows, pin, scores).select("SpecId", "RAW_FILE", "SEQUENCE", "Label", "f_price", "f_tax", "percolator_score")


@query("last_scores", FIX + _PIN + "SELECT PSMId, score FROM one")
def last_scores(spark, sf_dir):
    return merge.last_scores(_pin(spark, sf_dir)[2]).select("PSMId", "score")


@query("chimeric_scans", FIX + "SELECT RAW_FILE, SCAN_NUMBER FROM db GROUP BY ALL HAVING count(DISTINCT SEQUENCE) > 1")
def chimeric_scans(spark, sf_dir):
    return merge.chimeric_scans(search(spark, sf_dir, "database"))


@query("match_flags", FIX + "SELECT s.RAW_FILE, s.SCAN_NUMBER, SpecId, _merge AS found_by, unmodified_sequence_match, modified_sequence_match, precursor_charge_match, sequence_match, c.k IS NOT NULL AS chimeric FROM scans s LEFT JOIN (SELECT RAW_FILE, SCAN_NUMBER, 1 AS k FROM db GROUP BY ALL HAVING count(DISTINCT SEQUENCE) > 1) c ON c.RAW_FILE = s.RAW_FILE AND c.SCAN_NUMBER = s.SCAN_NUMBER")
def match_flags(spark, sf_dir):
    return scans(spark, sf_dir).select("RAW_FILE", "SCAN_NUMBER", "SpecId", F.col("_merge").alias("found_by"), "unmodified_sequence_match", "modified_sequence_match", "precursor_charge_match", "sequence_match", "chimeric")


_TIER = "CASE WHEN lev < 1 THEN 0 WHEN lev < 4 THEN 1 WHEN lev < 7 THEN 2 WHEN lev < 10 THEN 3 WHEN lev < 13 THEN 4 ELSE 5 END"


@query("tier_dispatch", FIX + f"SELECT found_by, kind, CASE WHEN lev IS NOT NULL THEN {_TIER} END AS tier, count(*) AS n, sum(lev)::DOUBLE AS total_distance FROM (SELECT _merge AS found_by, CASE WHEN _merge = 'shared' THEN CASE WHEN sequence_match THEN 'identical' WHEN unmodified_sequence_match THEN 'same_residues' ELSE 'different' END END AS kind, CASE WHEN _merge = 'shared' THEN levenshtein(SEQUENCE_database, SEQUENCE_denovo) END AS lev FROM scans) GROUP BY ALL")
def tier_dispatch(spark, sf_dir):
    """Flagship: how shared rows differ, by tier."""
    df = scans(spark, sf_dir).withColumn("lev", F.when(F.col("_merge") == "shared", F.levenshtein("SEQUENCE_database", "SEQUENCE_denovo")))
    return df.groupBy(F.col("_merge").alias("found_by"), C.shared_kind().alias("kind"), residues.tier(F.col("lev")).alias("tier")).agg(F.count("*").alias("n"), F.sum("lev").cast("double").alias("total_distance"))


_MASS = "round(list_sum(list_transform(string_split(SEQUENCE, ''), lambda c: map_extract_value(MAP {" + ", ".join(f"'{k}': {v}::DECIMAL(18, 6)" for k, v in residues.RESIDUE_MASS.items()) + "}, c))), 4)::DOUBLE"


@query("peptide_mass", FIX + f"SELECT DISTINCT SEQUENCE, {_MASS} AS mass FROM db")
def peptide_mass(spark, sf_dir):
    return search(spark, sf_dir, "database").select("SEQUENCE").distinct().select("SEQUENCE", residues.mass(F.col("SEQUENCE")).alias("mass"))


_PAIRS = f""", p AS (SELECT DISTINCT SEQUENCE_database AS a, SEQUENCE_denovo AS b FROM scans WHERE _merge = 'shared'),
ma AS (SELECT SEQUENCE AS s, {_MASS} AS m FROM (SELECT DISTINCT a AS SEQUENCE FROM p UNION SELECT b FROM p))
"""


@query("isobaric_anagram", FIX + _PAIRS + f"SELECT a, b, levenshtein(a, b)::INT AS levenshtein, abs(x.m - y.m) <= 0.000005 * greatest(x.m, y.m, 1.0) AS isobaric, list_sort(string_split(a, '')) = list_sort(string_split(b, '')) AS anagram, {_TIER.replace('lev', 'levenshtein(a, b)')} AS tier FROM p JOIN ma x ON x.s = a JOIN ma y ON y.s = b")
def isobaric_anagram(spark, sf_dir):
    pairs = scans(spark, sf_dir).where("_merge = 'shared'").select(F.col("SEQUENCE_database").alias("a"), F.col("SEQUENCE_denovo").alias("b")).distinct()
    return similarity.with_pair_measures(pairs).select("a", "b", "levenshtein", "isobaric", "anagram", "tier")


@query("spec_id_raw_file", FIX + "SELECT SpecId, regexp_extract(SpecId, '^(.+?)-\\d+-.+-\\d+$', 1) AS RAW_FILE FROM (SELECT SpecId FROM dbi UNION ALL SELECT SpecId FROM dni)")
def spec_id_raw_file(spark, sf_dir):
    ids = search(spark, sf_dir, "database").select("SpecId").union(search(spark, sf_dir, "denovo").select("SpecId"))
    return ids.select("SpecId", readers.raw_file_of(F.col("SpecId")).alias("RAW_FILE"))


@query("raw_files", FIX + "SELECT RAW_FILE FROM (SELECT RAW_FILE FROM db UNION SELECT RAW_FILE FROM dn) ORDER BY RAW_FILE LIMIT 5")
def raw_files(spark, sf_dir):
    return readers.raw_files(*(views.branch(spark, sf_dir, s) for s in SIDES), first=5)


@query("numbers_from_text", "SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9.]+)', 1) AS DOUBLE) AS value, TRY_CAST(TRY_CAST(regexp_extract(props, '([0-9.]+)', 1) AS DOUBLE) AS INT) AS whole FROM events")
def numbers_from_text(spark, sf_dir):
    text = F.regexp_extract("props", "([0-9.]+)", 1)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", readers.number(text).alias("value"), readers.number(F.round(readers.number(text)), "int").alias("whole"))


# tables written in the formats of the inputs and outputs and read back by the engine's own readers


def _text_files(df: DataFrame, name: str, sep: str) -> str:
    path = shared_folder(df.sparkSession, name)
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


_SEARCH = "RAW_FILE, SCAN_NUMBER, MODIFIED_SEQUENCE, PRECURSOR_CHARGE, MASS, SCORE, SEQUENCE, num_missed_cleavages, REVERSE"


@query("search_files", FIX + f"SELECT {_SEARCH}, 0::BIGINT AS errors FROM db")
def search_files(spark, sf_dir):
    """Search results as comma-separated files; columns stand in another order, and one more is ignored."""
    rows = views.branch(spark, sf_dir, "database").select("SEQUENCE", "Label", *(c for c in _SEARCH.split(", ") if c != "SEQUENCE"))
    found, errors = readers.read_search_checked(spark, _text_files(rows, "search", ",") + "/*.csv", "database", staged)
    return found.select(*_SEARCH.split(", ")).withColumn("errors", F.lit(errors.count()))


@query("feature_files", FIX + "SELECT SpecId, Label, f_discount, f_tax, f_price, f_quantity, RAW_FILE, 0::BIGINT AS errors FROM dbi")
def feature_files(spark, sf_dir):
    rows = search(spark, sf_dir, "database").select("SpecId", "Label", *views.FEATURES)
    found, errors = readers.read_features_checked(spark, _text_files(rows, "features", "\t"), "database features", staged)
    return found.withColumn("errors", F.lit(errors.count()))


@query("score_files", FIX + """SELECT SpecId AS PSMId, percolator_score AS score, 0.5::DOUBLE AS q_value, Label = 1 AS is_target, 0::BIGINT AS errors FROM dbi""")
def score_files(spark, sf_dir):
    """Scorer output of targets and decoys."""
    rows = search(spark, sf_dir, "database")
    cols = [F.col("SpecId").alias("PSMId"), F.col("percolator_score").alias("score"), F.lit(0.5).alias("q-value"), F.lit(0.25).alias("posterior_error_prob"), F.lit("-").alias("peptide")]
    paths = [_text_files(rows.where(c).select(*cols), "scores", "\t") for c in ("Label = 1", "Label <> 1")]
    found, errors = readers.read_scores_checked(spark, *paths, "database scores", staged)
    return found.select("PSMId", "score", F.col("q-value").alias("q_value"), "is_target").withColumn("errors", F.lit(errors.count()))


@query("raw_file_tables", FIX + "SELECT RAW_FILE, SCAN_NUMBER, SpecId, MASS, count(*) OVER (PARTITION BY RAW_FILE) AS rows_in_manifest FROM dni")
def raw_file_tables(spark, sf_dir):
    """A branch by raw file, written in two runs of which the second leaves alone what the first has written, with the rows that the manifest has."""
    path = shared_folder(spark, "by-raw-file")
    rows = search(spark, sf_dir, "denovo").select("RAW_FILE", "SCAN_NUMBER", "SpecId", "MASS")
    sinks.write_by_raw_file(rows.where("RAW_FILE < 'run_4'"), path)
    sinks.write_by_raw_file(rows, path, overwrite=False)
    found = readers.read_by_raw_file(spark, path).join(sinks.manifest(spark, path).withColumnRenamed("rows", "rows_in_manifest"), "RAW_FILE")
    return found.select("RAW_FILE", "SCAN_NUMBER", "SpecId", "MASS", "rows_in_manifest")


@query("train_cutoff", FIX + "SELECT count(*) AS n, round(sum(f_price), 4) AS total_price, min(percolator_score) AS least FROM (SELECT f_price_database AS f_price, percolator_score_database AS percolator_score, quantile_cont(percolator_score_database, 0.7) OVER () AS cut FROM scans WHERE _merge = 'shared' AND Label_database = 1 AND percolator_score_database > 0) WHERE percolator_score > cut")
def train_cutoff(spark, sf_dir):
    rows = forest.training_set(forest.training_candidates(scans(spark, sf_dir)))
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("f_price"), 4).alias("total_price"), F.min("percolator_score").alias("least"))


@query("train_denovo", FIX + "SELECT count(*) AS n, round(sum(f_price_denovo), 4) AS total_price FROM scans WHERE _merge <> 'database_only' AND SCORE_denovo >= 0.9")
def train_denovo(spark, sf_dir):
    rows = forest.training_set(forest.training_candidates(scans(spark, sf_dir), "denovo_score"), "denovo_score")
    return rows.agg(F.count("*").alias("n"), F.round(F.sum("f_price"), 4).alias("total_price"))


_LOHI = ", e AS (SELECT least(min(ISO_scores_database), min(ISO_scores_denovo)) AS lo, greatest(max(ISO_scores_database), max(ISO_scores_denovo)) AS hi FROM scans) "


@query("minmax_invert", FIX + _LOHI + "SELECT RAW_FILE, SCAN_NUMBER, round(1 - (ISO_scores_database - lo) / (hi - lo), 9) AS database, round(1 - (ISO_scores_denovo - lo) / (hi - lo), 9) AS denovo FROM scans, e")
def minmax_invert(spark, sf_dir):
    out = forest.rescaled(scans(spark, sf_dir))
    return out.select("RAW_FILE", "SCAN_NUMBER", *(F.round(f"ISO_scores_{s}", 9).alias(s) for s in SIDES))


@query("goodness", FIX + "SELECT s.side, s.v, round(coalesce(max(st.a_le), 0)::DOUBLE / max(nn.n), 9) AS goodness FROM (SELECT DISTINCT side, v FROM oth) s JOIN nn ON nn.side = s.side JOIN steps st ON st.side = s.side AND st.v = s.v GROUP BY s.side, s.v")
def goodness(spark, sf_dir):
    return ecdf.goodness_of(populations(scans(spark, sf_dir))).select("side", "v", F.round("goodness", 9).alias("goodness"))


@query("ks_cutoff", FIX + "SELECT side, n AS n_reference, m AS n_other, round(stat, 9) AS statistic, loc AS cutoff FROM ks")
def ks_cutoff(spark, sf_dir):
    return ecdf.ks_of(populations(scans(spark, sf_dir))).select("side", "n_reference", "n_other", F.round("statistic_D", 9).alias("statistic"), F.col("statistic_location").alias("cutoff"))


@query("ks_summary", FIX + "SELECT 'trusted_shared vs ' || side || '_only' AS comparison, n AS n_reference, m AS n_other, round(stat, 9) AS statistic_D, loc AS statistic_location, NULL::DOUBLE AS cutoff_iso_scores FROM ks UNION ALL SELECT 'cutoff_' || side, NULL, NULL, NULL, NULL, loc FROM ks")
def ks_summary(spark, sf_dir):
    """The summary without its p-values, see ks_pvalues."""
    return _summary(spark, sf_dir).drop("pvalue").withColumn("statistic_D", F.round("statistic_D", 9))


@query("ks_pvalues")
def ks_pvalues(spark, sf_dir):
    return _summary(spark, sf_dir).where("pvalue is not null").select("comparison", "pvalue")


def _summary(spark, sf_dir):
    found = ecdf.cutoffs_of(ecdf.ks_of(populations(scans(spark, sf_dir))))
    return ecdf.summary(spark, found, {s: f"trusted_shared vs {s}_only" for s in SIDES})


_CALLED = """, asked AS (SELECT 'database' AS side, ISO_scores_database AS v FROM scans WHERE ISO_scores_database IS NOT NULL UNION ALL SELECT 'denovo', ISO_scores_denovo FROM scans WHERE ISO_scores_denovo IS NOT NULL),
good AS (SELECT g.side, g.v, round(le::DOUBLE / nn.n, 9) AS goodness FROM (SELECT side, v, sum(a) OVER (PARTITION BY side ORDER BY v) AS le FROM
  (SELECT side, v, sum(r) AS a FROM (SELECT side, v, 1 AS r FROM ref UNION ALL SELECT side, v, 0 FROM asked) GROUP BY side, v)) g JOIN nn ON nn.side = g.side),
c AS  (SELECT (SELECT loc FROM ks WHERE side = 'database') AS cd, (SELECT loc FROM ks WHERE side = 'denovo') AS cn),
lists AS (
  SELECT SpecId, RAW_FILE, SCAN_NUMBER, ISO_scores_database, ISO_scores_denovo, SCORE_denovo AS CASANOVO_SCORE, SCORE_database AS DATABASE_SCORE, percolator_score_database AS PERCOLATOR_SCORE_DATABASE,
         replace(_merge, '_only', '') AS DETECTION_LEVEL, coalesce(SEQUENCE_denovo, SEQUENCE_database) AS SEQUENCE, replace(AA_SCORE_denovo, '|', ',') AS CASANOVO_AA_SCORE,
         CASE WHEN ISO_scores_database >= cd THEN 'GOOD' WHEN ISO_scores_database IS NOT NULL THEN 'BAD' END AS CALL_database,
         CASE WHEN ISO_scores_denovo >= cn THEN 'GOOD' WHEN ISO_scores_denovo IS NOT NULL THEN 'BAD' END AS CALL_denovo,
         gd.goodness AS TP_GOODNESS_database, gn.goodness AS TP_GOODNESS_denovo
  FROM scans CROSS JOIN c LEFT JOIN good gd ON gd.side = 'database' AND gd.v = ISO_scores_database LEFT JOIN good gn ON gn.side = 'denovo' AND gn.v = ISO_scores_denovo)
"""


#: What calls are made from, and what else the lists show.
_GRADED = ["_merge", "Label_database", "percolator_score_database", *(f"ISO_scores_{s}" for s in SIDES)]
_LISTED = ["SpecId", "RAW_FILE", "SCAN_NUMBER", "SCORE_database", "SCORE_denovo", "SEQUENCE_database", "SEQUENCE_denovo", "AA_SCORE_denovo"]


def _called(spark, sf_dir, shown=_LISTED):
    """The lists of all scans. Only what calls are made from and the columns to be shown are written; the others are null."""
    df = scans(spark, sf_dir).select(*_GRADED, *shown)
    missing = {c: t for c, t in scans(spark, sf_dir).select(*_LISTED).dtypes if c not in shown}
    df = C.with_missing(staged(df, "scans"), missing)
    df, found = ecdf.graded(df, dict.fromkeys(SIDES, C.trusted_shared()), {s: C.only_on(s) for s in SIDES})
    return calls.call_lists(df, {s: v["statistic_location"] for s, v in found.items()})


@query("good_list", FIX + _CALLED + "SELECT *, CASE DETECTION_LEVEL WHEN 'denovo' THEN TP_GOODNESS_denovo ELSE TP_GOODNESS_database END AS TP_GOODNESS FROM lists WHERE CASE DETECTION_LEVEL WHEN 'denovo' THEN CALL_denovo ELSE CALL_database END = 'GOOD'")
def good_list(spark, sf_dir):
    goodness = ["TP_GOODNESS", *(f"TP_GOODNESS_{s}" for s in SIDES)]
    return _called(spark, sf_dir).where("CALL = 'GOOD'").drop("CALL").withColumns({c: F.round(c, 9) for c in goodness})


@query("call_counts", FIX + _CALLED + "SELECT DETECTION_LEVEL, CALL_database, CALL_denovo, count(*) AS n, round(sum(TP_GOODNESS_database), 4) AS goodness_database, round(sum(TP_GOODNESS_denovo), 4) AS goodness_denovo FROM lists GROUP BY ALL")
def call_counts(spark, sf_dir):
    total = [F.round(F.sum(F.round(f"TP_GOODNESS_{s}", 9)), 4).alias(f"goodness_{s}") for s in SIDES]
    return _called(spark, sf_dir, []).groupBy("DETECTION_LEVEL", "CALL_database", "CALL_denovo").agg(F.count("*").alias("n"), *total)


@query("ranked_good_list", FIX + _CALLED + "SELECT SpecId, RAW_FILE, SCAN_NUMBER, row_number() OVER (ORDER BY tp DESC NULLS LAST, RAW_FILE, SCAN_NUMBER, SpecId) AS rank FROM (SELECT *, CASE DETECTION_LEVEL WHEN 'denovo' THEN TP_GOODNESS_denovo ELSE TP_GOODNESS_database END AS tp FROM lists WHERE CASE DETECTION_LEVEL WHEN 'denovo' THEN CALL_denovo ELSE CALL_database END = 'GOOD')")
def ranked_good_list(spark, sf_dir):
    """The order of the list of good matches, each with its place."""
    good = _called(spark, sf_dir, ["SpecId", "RAW_FILE", "SCAN_NUMBER"]).where("CALL = 'GOOD'")
    good = good.select("SpecId", "RAW_FILE", "SCAN_NUMBER", F.round("TP_GOODNESS", 9).alias("TP_GOODNESS"))
    return calls.with_rank(good).select("SpecId", "RAW_FILE", "SCAN_NUMBER", "rank")


@query("denovo_only_list", FIX + ", r AS (SELECT ISO_scores AS v FROM dn WHERE SCORE >= 0.6) SELECT SpecId, RAW_FILE, SCAN_NUMBER, ISO_scores, round((SELECT count(*) FROM r WHERE r.v <= d.ISO_scores)::DOUBLE / (SELECT count(*) FROM r), 9) AS TP_GOODNESS, SCORE AS CASANOVO_SCORE, SEQUENCE, replace(AA_SCORE, '|', ',') AS CASANOVO_AA_SCORE, CASE WHEN ISO_scores >= 0.5 THEN 'GOOD' ELSE 'BAD' END AS call FROM dni d")
def denovo_only_list(spark, sf_dir):
    df = C.suffixed(search(spark, sf_dir, "denovo"), "denovo").withColumns({"_merge": F.lit("denovo_only"), "SpecId": F.col("SpecId_denovo")})
    reference = ecdf.side_scores(df, {"denovo": C.trusted_denovo(0.6)})
    df = ecdf.with_goodness(df, reference.select("v"), "ISO_scores_denovo", "TP_GOODNESS_denovo")
    return calls.denovo_call_lists(df, 0.5).withColumn("TP_GOODNESS", F.round("TP_GOODNESS", 9)).withColumnRenamed("CALL", "call")


@query("denovo_populations", FIX + "SELECT count(*) FILTER (SCORE >= 0.9) AS trusted, count(*) FILTER (NOT coalesce(SCORE >= 0.9, false)) AS rest FROM dn")
def denovo_populations(spark, sf_dir):
    df = C.suffixed(views.branch(spark, sf_dir, "denovo"), "denovo").withColumn("_merge", F.lit("denovo_only"))
    return df.agg(F.count_if(C.trusted_denovo()).alias("trusted"), F.count_if(C.denovo_rest()).alias("rest"))


@query("detection_counts", FIX + "SELECT count(*) FILTER (_merge = 'shared' AND sequence_match) AS shared, count(*) FILTER (_merge = 'database_only' OR (_merge = 'shared' AND NOT sequence_match)) AS database, count(*) FILTER (_merge = 'denovo_only' OR (_merge = 'shared' AND NOT sequence_match)) AS denovo FROM scans")
def detection_counts(spark, sf_dir):
    return calls.detection_counts(scans(spark, sf_dir))


@query("shared_overview", FIX + "SELECT count(*) AS shared_scans, count(*) FILTER (sequence_match) AS shared_psms, round(count(*) FILTER (sequence_match)::DOUBLE / count(*), 9) AS agreement FROM scans WHERE _merge = 'shared'")
def shared_overview(spark, sf_dir):
    return plotdata.shared_overview(scans(spark, sf_dir)).withColumn("agreement", F.round("agreement", 9))


@query("level_counts", FIX + "SELECT level, count(*) FILTER (_merge = level || '_only' OR (_merge = 'shared' AND sequence_match = (level = 'shared'))) AS n FROM scans, (VALUES ('shared'), ('database'), ('denovo')) l(level) GROUP BY level")
def level_counts(spark, sf_dir):
    return plotdata.level_counts(scans(spark, sf_dir))


def _denovo_plots(spark, sf_dir):
    df = C.suffixed(views.branch(spark, sf_dir, "denovo"), "denovo").withColumn("_merge", F.lit("denovo_only"))
    return plotdata.denovo_plots(df, ecdf.side_scores(df, {"denovo": C.trusted_denovo()}), ecdf.side_scores(df, {"denovo": C.denovo_rest()}))


@query("denovo_length_density", FIX + "SELECT 'denovo' AS side, length(SEQUENCE)::INT AS length, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM dn WHERE SEQUENCE IS NOT NULL), 9) AS density, (SELECT median(length(SEQUENCE))::DOUBLE FROM dn) AS median FROM dn WHERE SEQUENCE IS NOT NULL GROUP BY 2")
def denovo_length_density(spark, sf_dir):
    return _denovo_plots(spark, sf_dir)["peptide_length"].withColumn("density", F.round("density", 9))


@query("denovo_ecdf_grid", FIX + ", p AS (SELECT coalesce(SCORE >= 0.9, false) AS good, ISO_scores AS x FROM dn WHERE ISO_scores IS NOT NULL), gr AS (SELECT i::DOUBLE / 500 AS v FROM range(501) r(i)) SELECT 'denovo' AS side, round(v, 9) AS v, round((SELECT count(*) FROM p WHERE good AND x <= v)::DOUBLE / (SELECT count(*) FROM p WHERE good), 9) AS reference, round((SELECT count(*) FROM p WHERE NOT good AND x <= v)::DOUBLE / (SELECT count(*) FROM p WHERE NOT good), 9) AS other FROM gr")
def denovo_ecdf_grid(spark, sf_dir):
    return _denovo_plots(spark, sf_dir)["ks_vs_tp"].select("side", *(F.round(c, 9).alias(c) for c in ("v", "reference", "other")))


@query("levenshtein_histogram", FIX + "SELECT levenshtein(SEQUENCE_database, SEQUENCE_denovo)::INT AS bin, count(*) AS n FROM scans WHERE _merge = 'shared' GROUP BY 1")
def levenshtein_histogram(spark, sf_dir):
    df = scans(spark, sf_dir).where("_merge = 'shared'").withColumn("PSA_LEVENSHTEIN", F.levenshtein("SEQUENCE_database", "SEQUENCE_denovo").cast("double"))
    return plotdata.levenshtein_histogram(df)


@query("length_density", FIX + ", l AS (SELECT 'database' AS side, length(SEQUENCE_database) AS length FROM scans WHERE _merge <> 'denovo_only' UNION ALL SELECT 'denovo', length(SEQUENCE_denovo) FROM scans WHERE _merge <> 'database_only') SELECT l.side, l.length::INT AS length, count(*) AS n, round(count(*)::DOUBLE / max(t.total), 9) AS density, max(t.median)::DOUBLE AS median FROM l JOIN (SELECT side, count(*) AS total, median(length) AS median FROM l GROUP BY side) t ON t.side = l.side GROUP BY l.side, l.length")
def length_density(spark, sf_dir):
    return plotdata.length_density(scans(spark, sf_dir)).withColumn("density", F.round("density", 9))


@query("score_histogram", FIX + "SELECT least(floor(ISO_scores * 100)::INT, 99) AS bin, count(*) AS n FROM dn WHERE ISO_scores BETWEEN 0 AND 1 GROUP BY 1")
def score_histogram(spark, sf_dir):
    return plotdata.histogram(views.branch(spark, sf_dir, "denovo"), "ISO_scores", 0.0, 1.0, 100)


_SP = ", sp AS (SELECT ISO_scores_database AS iso, percolator_score_database AS scorer, coalesce(Label_database = 1, false) AS target FROM scans WHERE _merge <> 'denovo_only'), lh AS (SELECT min(scorer) AS lo, max(scorer) AS hi FROM sp) "


@query("scorer_histogram", FIX + _SP + "SELECT target, least(floor((scorer - lo) / (hi - lo) * 120)::INT, 119) AS bin, count(*) AS n FROM sp, lh GROUP BY ALL")
def scorer_histogram(spark, sf_dir):
    pairs = plotdata.score_pairs(scans(spark, sf_dir), "database")
    ranged = pairs.crossJoin(F.broadcast(pairs.agg(F.min("scorer").alias("lo"), F.max("scorer").alias("hi"))))
    return plotdata.histogram(ranged, "scorer", F.col("lo"), F.col("hi"), 120, ["target"])


@query("score_quadrants", FIX + _SP + "SELECT CASE WHEN scorer >= 0 THEN 'top-' ELSE 'bottom-' END || CASE WHEN iso >= 0.6 THEN 'right' ELSE 'left' END AS quadrant, count(*) FILTER (target) AS target, count(*) FILTER (NOT target) AS decoy FROM sp GROUP BY 1")
def score_quadrants(spark, sf_dir):
    return plotdata.quadrants(plotdata.score_pairs(scans(spark, sf_dir), "database"), 0.6)


@query("score_hexagons", FIX + _SP + """, g AS (SELECT target, iso * 90 AS u, (scorer - lo) / (hi - lo) * 51 AS v, lo, hi FROM sp, lh),
c AS (SELECT *, round_even(u, 0) AS i, round_even(v, 0) AS j, floor(u) AS p, floor(v) AS q FROM g),
z AS (SELECT target, lo, hi, CASE WHEN near THEN i ELSE p + 0.5 END AS cx, CASE WHEN near THEN j ELSE q + 0.5 END AS cy FROM (SELECT *, (u - i) * (u - i) + 3 * (v - j) * (v - j) < (u - p - 0.5) * (u - p - 0.5) + 3 * (v - q - 0.5) * (v - q - 0.5) AS near FROM c))
SELECT z.target AS layer, round(cx / 90, 9) AS x, round(lo + cy / 51 * (hi - lo), 9) AS y, count(*) AS n, round(count(*)::DOUBLE / max(t.total), 9) AS weight FROM z JOIN (SELECT target, count(*) AS total FROM sp GROUP BY 1) t ON t.target = z.target GROUP BY ALL""")
def score_hexagons(spark, sf_dir):
    out = plotdata.hexagons(plotdata.score_pairs(scans(spark, sf_dir), "database"))
    return out.select("layer", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"), "n", F.round("weight", 9).alias("weight"))


@query("ecdf_grid", FIX + ", gr AS (SELECT s.side, i::DOUBLE / 500 AS v FROM range(501) r(i), (VALUES ('database'), ('denovo')) s(side)) SELECT gr.side, round(gr.v, 9) AS v, round((SELECT count(*) FROM ref WHERE ref.side = gr.side AND ref.v <= gr.v)::DOUBLE / nn.n, 9) AS reference, round((SELECT count(*) FROM oth WHERE oth.side = gr.side AND oth.v <= gr.v)::DOUBLE / nn.m, 9) AS other FROM gr JOIN nn ON nn.side = gr.side")
def ecdf_grid(spark, sf_dir):
    out = plotdata.ecdf_grid_of(populations(scans(spark, sf_dir)))
    return out.select("side", *(F.round(c, 9).alias(c) for c in ("v", "reference", "other")))


@query("q_values", FIX + """, best AS (SELECT * FROM (SELECT SpecId, percolator_score AS score, Label = 1 AS is_target, row_number() OVER (PARTITION BY RAW_FILE, SCAN_NUMBER ORDER BY percolator_score DESC, Label, SpecId) AS k FROM dbi) WHERE k = 1),
st AS (SELECT score, sum(t) OVER w AS t, sum(d) OVER w AS d FROM (SELECT score, count(*) FILTER (is_target) AS t, count(*) FILTER (NOT is_target) AS d FROM best GROUP BY score) WINDOW w AS (ORDER BY score DESC)),
q AS (SELECT score, min(least(1.0::DOUBLE, (d + 1)::DOUBLE / greatest(t, 1))) OVER (ORDER BY score) AS q FROM st)
SELECT SpecId, best.score AS score, is_target, round(q, 9) AS q_value FROM best JOIN q ON q.score = best.score""")
def q_values(spark, sf_dir):
    """Target-decoy competition of all database matches by the scorer's score, and q-values of those that stay."""
    rows = search(spark, sf_dir, "database").select("SpecId", F.col("percolator_score").alias("score"), (F.col("Label") == 1).alias("is_target"))
    return rescore.with_q_values(rows).select(F.col("PSMId").alias("SpecId"), "score", "is_target", F.round("q-value", 9).alias("q_value"))


@query("rescored_matches")
def rescored_matches(spark, sf_dir):
    features = staged(search(spark, sf_dir, "database").select("SpecId", "Label", *views.FEATURES), "features")
    out, _ = rescore.rescore(features)
    return out.select(F.col("PSMId").alias("SpecId"), F.round("score", 6).alias("score"), F.round("q-value", 9).alias("q_value"), F.round("posterior_error_prob", 9).alias("posterior_error_prob"), "is_target")


@query("static_scores", FIX + "SELECT SpecId, round(f_discount * 0.5 + f_tax * -0.25 + f_quantity * 0.125 + 1.5, 6) AS score FROM dbi")
def static_scores(spark, sf_dir):
    v = F.array("f_discount", "f_tax", "f_quantity")
    return search(spark, sf_dir, "database").select("SpecId", F.round(forest.weighted_score(v, [0.5, -0.25, 0.125, 1.5]), 6).alias("score"))


@query("feature_columns", FIX + "SELECT SpecId, f_price, f_quantity FROM dbi")
def feature_columns(spark, sf_dir):
    out = C.drop_columns(search(spark, sf_dir, "database"), "not_there f_tax f_discount")
    return out.select("SpecId", *(c for c in out.columns if c.startswith("f_")))


@query("align_events")
def align_events(spark, sf_dir, details=tuple(d for d in similarity.DETAILS if d != "events")):
    pairs = scans(spark, sf_dir).where("_merge = 'shared' and not unmodified_sequence_match").select(F.col("SEQUENCE_database").alias("a"), F.col("SEQUENCE_denovo").alias("b"))
    return similarity.classify_pairs(pairs, details)


@query("align_measures", FIX + _PAIRS + f"SELECT a, b, levenshtein(a, b)::INT AS levenshtein, abs(x.m - y.m) <= 0.000005 * greatest(x.m, y.m, 1.0) AS isobaric, list_sort(string_split(a, '')) = list_sort(string_split(b, '')) AS anagram, {_TIER.replace('lev', 'levenshtein(a, b)')} AS tier, x.m AS mass1, y.m AS mass2, a AS first_residues, b AS second_residues, true AS aligned, 'PSA - Tier ' || {_TIER.replace('lev', 'levenshtein(a, b)')} || CASE WHEN abs(x.m - y.m) <= 0.000005 * greatest(x.m, y.m, 1.0) THEN ' - ISOBARIC - ' ELSE ' - NONISOBARIC - ' END AS label FROM p JOIN ma x ON x.s = a JOIN ma y ON y.s = b WHERE a <> b")
def align_measures(spark, sf_dir):
    """What SQL can say of align_events: measures, the label up to its event, and that the aligned texts hold both peptides, with a mark for each place."""
    out = align_events(spark, sf_dir, ("first", "marks", "second"))
    whole = F.col("error").isNull() & (F.length("first") == F.length("second")) & (F.length("first") == F.length("marks"))
    residues_of = (F.replace(c, F.lit("-"), F.lit("")).alias(f"{c}_residues") for c in ("first", "second"))
    return out.select("a", "b", "levenshtein", "isobaric", "anagram", "tier", "mass1", "mass2", *residues_of, whole.alias("aligned"), F.regexp_extract("label", "^PSA - Tier [0-9] - (NON)?ISOBARIC - ", 0).alias("label"))


@query("align_event_rows", FIX + _PAIRS + " SELECT a, b, a AS first_rebuilt, b AS second_rebuilt, true AS blocks_hold, true AS places_add_up FROM p WHERE a <> b")
def align_event_rows(spark, sf_dir):
    """What SQL can say of the events: each block is cut from its peptide at its place and is what its name says, and blocks and equal runs make up both peptides."""
    out = align_events(spark, sf_dir, ("first", "marks", "second", "events"))
    rows = out.select("a", "b", "first", "second", "marks", F.explode("events").alias("e"))

    def cut(of: str):
        return F.replace(F.substr(of, F.col("e.pos") + 1, F.col("e.k")), F.lit("-"), F.lit(""))

    one, two = F.col("e.seq1"), F.col("e.seq2")
    aligned = (F.substr(c, F.col("e.pos") + 1, F.col("e.k")) for c in ("first", "second"))
    differ = F.forall(F.zip_with(*(F.split(x, "") for x in aligned), lambda x, y: (x == "") | (x != y)), lambda x: x)
    holds = F.when(F.col("e.event").isin("SWAP", "SHUFFLE"), residues.anagram(one, two) & (one != two))
    holds = holds.when(F.col("e.event") == "ISOBARIC-SUBSTITUTION", F.abs(residues.mass(one) - residues.mass(two)) <= 0.01 * F.col("e.k"))
    holds = holds.when(F.col("e.event") == "DELETION", (two == "") & (one != "")).when(F.col("e.event") == "INSERTION", (one == "") & (two != ""))
    holds = holds.otherwise(differ & (F.length(one) == F.length(two))) & (one == cut("first")) & (two == cut("second"))
    per_pair = rows.groupBy("a", "b", "first", "second", "marks").agg(F.bool_and(holds).alias("blocks_hold"), F.sum("e.k").alias("k"))
    equal_runs = F.length("marks") - F.length(F.replace("marks", F.lit("|"), F.lit("")))
    rebuilt = {f"{c}_rebuilt": F.replace(c, F.lit("-"), F.lit("")) for c in ("first", "second")}
    return per_pair.withColumns(rebuilt).select("a", "b", *rebuilt, "blocks_hold", (F.col("k") + equal_runs == F.length("marks")).alias("places_add_up"))


@query("similarity_kinds", FIX + f", k AS (SELECT scans.*, levenshtein(SEQUENCE_database, SEQUENCE_denovo) AS lev FROM scans), ma AS (SELECT SEQUENCE AS s, {_MASS} AS m FROM (SELECT DISTINCT SEQUENCE_database AS SEQUENCE FROM scans WHERE _merge = 'shared' UNION SELECT SEQUENCE_denovo FROM scans WHERE _merge = 'shared')) SELECT CASE WHEN _merge = 'shared' THEN 'PSA - Tier ' || CASE WHEN sequence_match OR unmodified_sequence_match THEN '0' ELSE {_TIER}::VARCHAR || CASE WHEN abs(x.m - y.m) <= 0.000005 * greatest(x.m, y.m, 1.0) THEN ' - ISOBARIC' ELSE ' - NONISOBARIC' END END END AS kind, count(*) AS n, sum(CASE WHEN _merge <> 'shared' THEN NULL WHEN sequence_match OR unmodified_sequence_match THEN 0 ELSE lev END)::DOUBLE AS total_distance, 0::BIGINT AS errors FROM k LEFT JOIN ma x ON _merge = 'shared' AND x.s = SEQUENCE_database LEFT JOIN ma y ON _merge = 'shared' AND y.s = SEQUENCE_denovo GROUP BY 1")
def similarity_kinds(spark, sf_dir):
    """What SQL can say of similarity_labels: rows by tier and mass."""
    out = similarity.with_similarity(scans(spark, sf_dir))
    kind = F.regexp_extract("PSA", "^PSA - Tier [0-9]( - ISOBARIC| - NONISOBARIC)?", 0)
    return out.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum("PSA_LEVENSHTEIN").alias("total_distance"), F.count("PSA_ERROR").alias("errors"))


@query("similarity_labels")
def similarity_labels(spark, sf_dir):
    out = similarity.with_similarity(scans(spark, sf_dir))
    return out.groupBy("PSA").agg(F.count("*").alias("n"), F.sum("PSA_LEVENSHTEIN").alias("total_distance"), F.count("PSA_ERROR").alias("errors"))


@query("forest_scores")
def forest_scores(spark, sf_dir):
    """An id is made of its parts at the end, so that it is neither written nor shuffled on the way."""
    features, parts = (f"{f}_{s}" for f in views.FEATURES for s in SIDES), ("MODIFIED_SEQUENCE", "PRECURSOR_CHARGE")
    whole = reduce(lambda a, b: a & b, (F.col(f"{c}_database").isNotNull() for c in parts))
    of_id = (F.when(whole, F.col(f"{c}_database")).otherwise(F.col(f"{c}_denovo")).alias(c) for c in parts)
    df = staged(scans(spark, sf_dir).select("RAW_FILE", "SCAN_NUMBER", *of_id, "_merge", "Label_database", "percolator_score_database", *features), "scans")
    rows = forest.training_set(forest.training_candidates(df).select(*C.features_of(df, "database")))
    _, model = forest.fit(rows, views.FEATURES)
    spec_id = C.spec_id(*map(F.col, ("RAW_FILE", "SCAN_NUMBER", *parts))).alias("SpecId")
    scored = forest.score_sides(df, model, views.FEATURES).select("RAW_FILE", "SCAN_NUMBER", spec_id, *(f"ISO_{n}_{s}" for n in ("labels", "scores") for s in SIDES))
    out = forest.rescaled(staged(scored, "forest-scores"))
    return out.select("RAW_FILE", "SCAN_NUMBER", "SpecId", *(f"ISO_{n}_{s}" for n in ("labels", "scores") for s in SIDES))
