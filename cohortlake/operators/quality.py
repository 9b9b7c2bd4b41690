"""Findings tables: the rules that a record table, its dimensions and its stored results must meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlake.tables import written

# Allowed values of the closed columns, required columns, conditional ones, and fields that must not be made up.
ENUMS = {
    "sample_type": ["Urine", "Blood", "CordBlood", "BreastMilk", "Nail", "Hair", "Serum", "Plasma", "Other"],
    "population_group": ["Adults", "Minors", "Pregnant", "Elderly", "Mixed", "Unknown"],
    "gender": ["Male", "Female", "Both", "Unknown"],
    "stat_type": ["GM_GSD", "GM_only", "AM_SD", "Median_IQR", "Median_Range", "Median_only", "Min_Max", "P25_P75", "Other"],
    "adjusted": ["No", "Creatinine", "SpecificGravity", "ReferenceConversion", "NotApplicable"],
    "blood_matrix": ["WholeBlood", "Serum", "Plasma", "Unspecified"],
    "analyte_species": ["Total", "iAs", "iAs+MMA+DMA", "MeHg", "Unknown"],
    "inclusion_decision": ["Include", "Exclude", "Pending"],
    "extracted_by": ["AI", "Human", "AI+Human"],
    "region": ["North", "Northeast", "East", "Central", "South", "Southwest", "Northwest", "UNKNOWN"],
}
REQUIRED_COLUMNS = [
    "record_id", "study_no", "title", "author", "doi", "t_publication", "time", "country", "province", "region", "population", "population_group",
    "flag_occupational", "flag_disease", "flag_endemic_area", "flag_mixed_occupational", "inclusion_decision", "sample_type", "analyte",
    "stat_type", "unit_original", "sample_size", "extracted_by", "verified", "snapshot_tag", "row_hash",
]
CONDITIONAL = [("sample_type", "Blood", "blood_matrix"), ("sample_type", "Urine", "adjusted"), ("inclusion_decision", "Exclude", "exclusion_reason")]
NOT_IMPUTED = ["gm_summary", "sample_size", "time", "sample_type"]
TRUE = ["true", "1", "yes", "y", "是"]
# Required of the record view, which names the sampling year otherwise.
REQUIRED = ["record_id", "study_no", "title", "author", "t_publication", "sampling_year", "population_group", "sample_type", "analyte", "stat_type", "unit_original", "sample_size"]


def _finding(rule: str, severity: str, field: str, broken: Column) -> Column:
    return F.when(broken, F.struct(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(field).alias("field")))


def row_findings(df: DataFrame) -> DataFrame:
    """record_id, rule, severity, field: all rules on single records, in one projection."""
    c, gm = F.col, F.col("gm_direct")
    rules = [_finding("required", "ERROR", f, c(f).isNull() | (F.trim(c(f).cast("string")) == "")) for f in REQUIRED if f in df.columns]
    rules += [_finding("enum", "ERROR", f, ~c(f).isin(*allowed)) for f, allowed in ENUMS.items() if f in df.columns and f != "region"]
    rules += [
        _finding("conditional", "ERROR", "blood_matrix", (c("sample_type") == "Blood") & c("blood_matrix").isNull()),
        _finding("conditional", "ERROR", "adjusted", (c("sample_type") == "Urine") & c("adjusted").isNull()),
        _finding("numeric", "ERROR", "sample_size", c("sample_size") <= 0),
        _finding("numeric", "ERROR", "sampling_year", ~c("sampling_year").between(1900, 2100)),
        _finding("numeric", "ERROR", "gm_direct", gm <= 0),
        _finding("suspicious", "ERROR", "time_after_publication", c("sampling_year") > c("t_publication")),
        _finding("suspicious", "WARN", "time_is_publication", c("sampling_year") == c("t_publication")),
        _finding("suspicious", "ERROR", "p25_over_median", c("initial_p25") > c("initial_median")),
        _finding("suspicious", "ERROR", "p75_under_median", c("initial_p75") < c("initial_median")),
        _finding("suspicious", "ERROR", "min_over_max", c("initial_min") > c("initial_max")),
        _finding("suspicious", "ERROR", "gsd_under_one", c("initial_gsd") < 1),
        _finding("suspicious", "WARN", "gm_over_mean", c("initial_gm") > 1.5 * c("initial_mean")),
        _finding("suspicious", "ERROR", "gm_outside_range", (gm < c("initial_min")) | (gm > c("initial_max"))),
        _finding("suspicious", "WARN", "urine_magnitude", (c("sample_type") == "Urine") & ((gm > 1000) | (gm < 0.1))),
    ]
    found = F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull()))
    return df.select("record_id", found.alias("f")).select("record_id", "f.*")


def missing_columns(df: DataFrame) -> list[str]:
    """Columns of the contract that the table lacks, in the contract's order."""
    return [c for c in REQUIRED_COLUMNS if c not in df.columns]


def contract_findings(df: DataFrame, unit_policy: dict[str, str], least_verified: float = 0.9) -> DataFrame:
    """record_id, rule, severity, field: every rule of the contract. Rules on rows are one projection; groups and the whole table add theirs.

    Columns that the table lacks are findings of the first rule, with a null record_id, and break no other one.
    """
    have = {*df.columns}
    text = lambda f: F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) if f in have else F.lit("")
    blank = lambda f: text(f) == ""
    num = lambda f: F.expr(f"try_cast({f} AS double)") if f in have else F.lit(None).cast("double")
    year, pub, gm, mean, median, low, high = map(num, ("time", "t_publication", "initial_gm", "initial_mean", "initial_median", "initial_min", "initial_max"))
    flags, path = text("inferred_flags"), text("conversion_path")
    rules = [_finding("enum", "ERROR", f, ~blank(f) & ~text(f).isin(*allowed)) for f, allowed in ENUMS.items() if f in have]
    rules += [_finding("conditional", "ERROR", need, (text(f) == value) & blank(need)) for f, value, need in CONDITIONAL]
    rules += [_finding("numeric", "ERROR", f, num(f) <= 0) for f in ("sample_size", "initial_gm", "gm_summary", "initial_gsd", "gsd_summary")]
    expected = F.lit(None).cast("string")
    for matrix, unit in unit_policy.items():
        expected = F.when(text("sample_type") == matrix, unit).otherwise(expected)
    off_policy = ~blank("unit_final") & (text("unit_final") != expected)
    gravity = text("adjusted") == "SpecificGravity"
    magnitude = F.coalesce(gm, num("gm_summary"))
    generic = flags.contains("value_interpolated") & ~flags.contains("value_interpolated_")
    known = F.coalesce(*[F.when(~blank(f), f) for f in NOT_IMPUTED])
    rules += [
        _finding("numeric", "ERROR", "time", ~year.between(1900, 2100)),
        _finding("unit_policy", "ERROR", "unit_final", off_policy & ~gravity),
        _finding("unit_policy", "WARN", "unit_final", off_policy & gravity),
        _finding("inferred", "ERROR", "inferred_flags", (path.contains("Wan_") | path.contains("unit_converted")) & (flags == "")),
        *[_finding("imputed", "ERROR", f, flags.contains(f"value_interpolated_{f}")) for f in NOT_IMPUTED],
        *[_finding("imputed", "ERROR", f, generic & (known == f)) for f in NOT_IMPUTED],
        _finding("gm_over_mean", "WARN", "initial_gm", (mean > 0) & (gm > 1.5 * mean)),
        _finding("gm_is_mean", "WARN", "initial_gm", gm == mean),
        _finding("quantiles", "ERROR", "initial_p25", num("initial_p25") > median),
        _finding("quantiles", "ERROR", "initial_p75", num("initial_p75") < median),
        _finding("range", "ERROR", "initial_min", low > high),
        _finding("gsd_under_one", "WARN", "initial_gsd", num("initial_gsd") < 1),
        _finding("gm_under_min", "WARN", "initial_gm", gm < low),
        _finding("gm_over_max", "WARN", "initial_gm", gm > high),
        _finding("time", "ERROR", "time", year > pub),
        _finding("time", "WARN", "time", year == pub),
        _finding("interval", "ERROR", "time_start", num("time_start") > num("time_end")),
        _finding("magnitude", "WARN", "unit_original", (text("sample_type") == "Urine") & ((magnitude > 1000) | (magnitude < 0.1))),
        _finding("magnitude", "WARN", "gm_summary", (text("sample_type") == "Blood") & (num("gm_summary") > 50)),
    ]
    strata = [f for f in ("study_no", "sample_type", "population", "time") if f in have]
    verified = [F.lower(text("verified")).isin(*TRUE).alias("_verified")] if "verified" in have else []
    # Written once with what groups need, so that the record table is read once.
    each = df.select(F.col("record_id").cast("string").alias("record_id"), F.filter(F.array(*rules), lambda x: x.isNotNull()).alias("found"), *[text(f).alias(f"_{f}") for f in strata], *verified)
    each = written(each, "contract-rules")
    out = each.select("record_id", F.explode("found").alias("f")).select("record_id", "f.*")
    whole = lambda rule, severity, field: [F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(field).alias("field")]
    if len(strata) == 4:
        again = F.row_number().over(Window.partitionBy(*[f"_{f}" for f in strata]).orderBy("record_id"))
        out = out.unionByName(each.select("record_id", again.alias("n")).where("n > 1").select("record_id", *whole("repeated_stratum", "WARN", "study_no,sample_type,population,time")))
    out = out.unionByName(each.where(F.trim(F.coalesce("record_id", F.lit(""))) != "").groupBy("record_id").agg(F.count("*").alias("n")).where("n > 1").select("record_id", *whole("unique_id", "ERROR", "record_id")))
    none = F.lit(None).cast("string").alias("record_id")
    if verified:
        share = each.agg(F.avg(F.col("_verified").cast("double")).alias("share")).where("share IS NOT NULL")
        out = out.unionByName(share.select(none, F.lit("verified").alias("rule"), F.when(F.col("share") < least_verified, "ERROR").otherwise("WARN").alias("severity"), F.lit("verified").alias("field")))
    if missing := missing_columns(df):
        out = out.unionByName(df.sparkSession.createDataFrame([(None, "columns", "ERROR", f) for f in missing], out.schema))
    return out


def open_fields(df: DataFrame) -> DataFrame:
    """record_id, field: the blank required and conditional fields of each record, a list of what is to be looked up."""
    blank = lambda f: F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) == ""
    tests = [F.when(blank(f), f) for f in REQUIRED_COLUMNS if f in df.columns]
    tests += [F.when((F.col(f) == value) & blank(need), need) for f, value, need in CONDITIONAL if {f, need} <= {*df.columns}]
    return df.select("record_id", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())).alias("field"))


def gate_metrics(df: DataFrame, known_flags: list[str]) -> DataFrame:
    """One row: verified share, pending decisions, means without a path, records with unknown flags."""
    blank = lambda f: F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) == ""
    unknown = F.exists(F.split(F.coalesce("inferred_flags", F.lit("")), ";"), lambda x: (F.trim(x) != "") & ~F.trim(x).isin(*known_flags))
    return df.agg(
        F.count("*").alias("n_records"), F.round(F.avg(F.lower(F.trim(F.col("verified").cast("string"))).isin(*TRUE).cast("double")), 6).alias("share_verified"), F.count_if(F.col("inclusion_decision") == "Pending").alias("n_pending"),
        F.count_if(F.col("gm_summary").isNotNull() & blank("conversion_path")).alias("n_without_path"), F.count_if(unknown).alias("n_unknown_flags"),
    )


def forbidden_cells(df: DataFrame, key: str) -> DataFrame:
    """key, field, kind: cells of text columns that identify a publication (DOI, PMID, volume and pages, author and year), placeholders aside."""
    # The forbidden patterns and the placeholders that are allowed.
    forbidden = {"doi": r"\b10\.\d{4,9}/[a-z0-9.\-]+", "pmid": r"\b(PMID|pmid)\s*[:：]?\s*\d+", "volume": r"\b(19|20)\d{2};\s*\d+\s*[:：]", "author_year": r"(?:等|et al\.)\s*[（(]\s*(19|20)\d{2}"}
    allowed = r"EXAMPLE-|10\.xxxx/|NO_DOI|示例"
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name != key]
    cells = [F.when(F.col(f"`{f}`").rlike(pattern) & ~F.col(f"`{f}`").rlike(allowed), F.struct(F.lit(f).alias("field"), F.lit(kind).alias("kind"))) for f in texts for kind, pattern in forbidden.items()]
    return df.select(key, F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("c")).select(key, "c.*")


def repeated_ids(df: DataFrame, key: str = "record_id") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def repeated_strata(df: DataFrame) -> DataFrame:
    """The second and later records of a study, matrix, population and year, with the first one's id."""
    w = Window.partitionBy("study_no", "sample_type", "population_group", "sampling_year").orderBy("record_id")
    ranked = df.withColumns({"n": F.row_number().over(w), "first_id": F.first("record_id").over(w)})
    return ranked.where("n > 1").select("record_id", "first_id")


def same_sample_size(df: DataFrame) -> DataFrame:
    """Studies of several records that all report one sample size."""
    return df.groupBy("study_no").agg(F.count("*").alias("n_records"), F.countDistinct("sample_size").alias("k")).where("n_records > 1 AND k = 1").drop("k")


def readiness(standard: DataFrame) -> DataFrame:
    """One row: what stands between the table and its release."""
    return standard.agg(F.count("*").alias("n_records"), F.count_if(F.col("status") == "FAILED").alias("n_failed"), F.count_if(F.col("gm_summary").isNotNull() & (F.col("conversion_path") == "")).alias("n_without_path"), F.round(F.avg(F.when(F.col("conversion_path").contains("Wan_S"), 1.0).otherwise(0.0)), 6).alias("share_estimated"))


def missing_fields(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, n_missing, share over all records."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).isNull().alias("gone")) for f in fields]))
    return df.select(pairs.alias("p")).groupBy("p.field").agg(F.count_if("p.gone").alias("n_missing"), F.round(F.avg(F.col("p.gone").cast("double")), 6).alias("share"))


def drift(old: DataFrame, new: DataFrame, fields: list[str], key: str = "record_id") -> DataFrame:
    """key, change: added, removed or changed, by the hash of the contract fields."""
    digest = lambda d: d.select(key, F.sha2(F.concat_ws("|", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]), 256).alias("digest"))
    both = digest(old).withColumnRenamed("digest", "before").join(digest(new).withColumnRenamed("digest", "after"), key, "full_outer")
    change = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(F.col("before") != F.col("after"), "changed")
    return both.select(key, change.alias("change")).where("change IS NOT NULL")


def stale(artefacts: DataFrame, current: DataFrame, key: str = "snapshot_tag") -> DataFrame:
    """Artefacts whose digest isn't the current one; a missing digest is stale."""
    now = current.select(key, F.col("sha256").alias("now"))
    return artefacts.join(now, key, "left").where(F.coalesce(F.col("sha256") != F.col("now"), F.lit(True))).drop("now")
