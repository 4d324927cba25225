"""Per-asset roll-up, feature table, encoders and profile."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import exact_quantiles
from ..schemas import ECC_FAMILY, FEATURES, FEATURE_NAMES, SCHEMA_VERSION, required_columns
from ..sources.inventory import finding_id


def finding_rollup(findings: DataFrame) -> DataFrame:
    """Counts, latest finding and primary-finding attributes per asset.

    The primary finding (D6/B1: latest discovered_at, then order and line desc)
    is the max of a struct, so the whole roll-up is one partial-aggregated
    group-by; no window and no per-asset collection. The rows it sorts hold no
    finding_id: it follows from the order and line of the one finding kept.
    """
    rolled = findings.groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("n_findings"),
        F.count_if(F.col("quantum_vulnerable")).alias("n_vulnerable"),
        F.count_if(F.col("quantum_vulnerable").isNull()).alias("n_unknown"),
        F.max("discovered_at").alias("last_discovered_at"),
        F.max(F.struct(
            F.col("discovered_at"), F.col("order_key"), F.col("line_no"),
            F.col("algorithm"), F.col("key_size"), F.col("source"), F.col("quantum_vulnerable"),
        )).alias("primary"),
    )
    return rolled.withColumn("primary", F.col("primary").withField(
        "finding_id", finding_id(F.col("primary.order_key"), F.col("primary.line_no"))))


def dependency_count(edges: DataFrame) -> DataFrame:
    """Out-degree per asset (partial-aggregated)."""
    return edges.groupBy(F.col("src").alias("asset_id")).agg(F.count(F.lit(1)).alias("dependency_count"))


def asset_features(assets: DataFrame, rollup: DataFrame, deps: DataFrame) -> DataFrame:
    """One row per asset; per-asset aggregates are joined (never raw findings), so no fan-out."""
    j = assets.join(rollup, "asset_id", "left").join(deps, "asset_id", "left")
    alg = F.col("primary.algorithm")
    return j.select(
        "asset_id",
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.coalesce((alg == "RSA").cast("int"), F.lit(0)).alias("algorithm_RSA"),
        F.coalesce(alg.isin(*ECC_FAMILY).cast("int"), F.lit(0)).alias("algorithm_ECC"),
        F.coalesce(F.col("primary.key_size"), F.lit(0)).alias("key_size"),
        F.coalesce(F.col("primary.quantum_vulnerable").cast("int"), F.lit(0)).alias("quantum_vulnerable"),
        "internet_accessible",
        F.coalesce((F.col("primary.source") == "tls_scan").cast("int"), F.lit(0)).alias("has_public_cert"),
        "network_zone",
        "financial_data",
        "customer_data",
        "regulated_system",
        "criticality",
        F.coalesce(F.col("dependency_count"), F.lit(0)).alias("dependency_count"),
        "loc_estimate",
        "migration_complexity",
        "asset_age_days",
        "previous_incident_flag",
        alg.alias("algorithm"),
        F.col("primary.quantum_vulnerable").alias("qv_raw"),
        F.coalesce(F.col("n_findings"), F.lit(0)).alias("n_findings"),
    )


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """P5: an empty batch is an error."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def fit_medians(df: DataFrame, rows: DataFrame | None = None) -> dict[str, float]:
    """Exact median, over `df` (the training rows), of every numeric feature that has missing values in `rows`
    (all rows to be encoded; `df` if not given).

    The one documented limitation of training: a missing number is taken to be the median.
    """
    numeric = [name for name, kind, _ in FEATURES if kind != "categorical"]
    missing = (df if rows is None else rows).agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in numeric)).first()
    medians = {c: exact_quantiles(df, c, [0.5])[0] for c in numeric if missing[c]}
    return {c: 0.0 if m is None else float(m) for c, m in medians.items()}


def impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()}) if medians else df


def _category_lookup(c: Column, cats: dict[str, float], case_insensitive: bool = False) -> Column:
    key = F.upper(c) if case_insensitive else c
    chain = None
    for name, code in cats.items():
        k = name.upper() if case_insensitive else name
        chain = F.when(key == k, F.lit(code)) if chain is None else chain.when(key == k, F.lit(code))
    return chain


def encode_features(df: DataFrame, mode: str = "lenient", keep: tuple[str, ...] = ("asset_id",)) -> DataFrame:
    """P2/P3 (lenient, training) and P4 (strict, serving) encoders.

    Output has the kept key columns, one double column per feature, and an
    `encode_error` column (NULL when the row is good) so bad rows can be
    routed to an error table instead of failing the whole batch.
    """
    if mode not in ("lenient", "strict"):
        raise ValueError("mode must be lenient or strict")
    required_columns(df.columns, FEATURE_NAMES, "feature table")
    types = dict(df.dtypes)
    cols, errors = [], []
    for name, kind, cats in FEATURES:
        c = F.col(name)
        dtype = types[name]
        if kind == "categorical":
            v = _category_lookup(c, cats)
            err = F.when(c.isNull(), F.lit(f"missing feature {name}")).when(
                v.isNull(), F.concat(F.lit(f"unknown category for {name}: "), c.cast("string")))
        elif dtype in ("int", "bigint", "smallint", "tinyint", "double", "float") or dtype.startswith("decimal"):
            # already numeric: a plain cast, no parsing
            v = c.cast("double")
            err = F.when(c.isNull(), F.lit(f"missing feature {name}"))
        elif dtype == "boolean" and mode == "lenient":
            v = c.cast("double")
            err = F.when(c.isNull(), F.lit(f"missing feature {name}"))
        elif mode == "strict":  # text and booleans are no numbers, whatever they spell
            v = F.lit(None).cast("double")
            err = F.when(c.isNull(), F.lit(f"missing feature {name}")).otherwise(F.lit(f"feature {name} must be a number"))
        else:
            v = c.cast("string").try_cast("double")
            err = F.when(c.isNull(), F.lit(f"missing feature {name}")).when(
                v.isNull(), F.lit(f"feature {name} must be a number"))
        if mode == "strict":
            v = v.cast("float").cast("double")  # serving precision (f32)
        cols.append(v.alias(name))
        errors.append(err)
    return df.select(*keep, *cols, F.concat_ws("; ", *errors).alias("_err")).select(
        *keep, *FEATURE_NAMES, F.when(F.col("_err") == "", None).otherwise(F.col("_err")).alias("encode_error")
    )


def encode_instances(df: DataFrame, instance: str, keep: tuple[str, ...] = ("asset_id",)) -> DataFrame:
    """Strict encode of JSON objects (one instance per row) by the type each value has in the JSON.

    A number must be a JSON number and a category a known JSON string, case-sensitive; a missing
    or null value is an error; other keys are ignored. Same output as `encode_features`.
    """
    no_codes = F.create_map().cast("map<string,double>")
    wanted = F.array(*(F.struct(
        F.lit(name).alias("name"), F.lit(kind == "categorical").alias("categorical"),
        (F.create_map(*(F.lit(x) for pair in cats.items() for x in pair)) if cats else no_codes).alias("codes"))
        for name, kind, cats in FEATURES))

    def typed(f: Column) -> Column:
        value = F.try_element_at(F.col("_m"), f["name"])
        return F.struct(f.alias("f"), F.schema_of_variant(value).alias("type"),
                        F.try_variant_get(value, "$", "string").alias("text"))

    def encoded(x: Column) -> Column:
        name, code = x["f"]["name"], F.try_element_at(x["f"]["codes"], x["text"])
        number = x["type"].rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        error = (F.when(x["type"].isNull() | (x["type"] == "VOID"), F.concat(F.lit("missing feature "), name))
                 .when(~x["f"]["categorical"] & ~number, F.concat(F.lit("feature "), name, F.lit(" must be a number")))
                 .when(x["f"]["categorical"] & (x["type"] != "STRING"),
                       F.concat(F.lit("feature "), name, F.lit(" must be a known string")))
                 .when(x["f"]["categorical"] & code.isNull(),
                       F.concat(F.lit("unknown category for "), name, F.lit(": "), x["text"])))
        value = F.when(x["f"]["categorical"], code).when(number, x["text"].try_cast("double"))
        return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))

    # one lambda for all features: the generated code stays short
    d = df.withColumn("_m", F.try_variant_get(F.try_parse_json(F.col(instance)), "$", "map<string,variant>"))
    d = d.withColumn("_x", F.transform(F.transform(wanted, typed), encoded))
    errors = F.nullif(F.array_join(F.transform("_x", lambda x: x["error"]), "; "), F.lit(""))
    fields = [*(F.get("_x", F.lit(i))["value"].cast("float").cast("double").alias(n) for i, n in enumerate(FEATURE_NAMES)),
              F.when(F.col("_m").isNull(), F.lit("instance is not a JSON object")).otherwise(errors).alias("encode_error")]
    # a generator: a filter on the result isn't pushed below it, where each instance would be parsed a second time
    return d.select(*keep, F.inline(F.array(F.struct(*fields))))


def feature_profile(features: DataFrame) -> DataFrame:
    """Null rate of every feature and the row count, in one pass, long format."""
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.avg(F.col(c).isNull().cast("double")).alias(c) for c in FEATURE_NAMES
    ]
    wide = features.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in FEATURE_NAMES)
    return wide.selectExpr("__rows AS row_count", f"stack({len(FEATURE_NAMES)}, {stack}) AS (feature, null_rate)")
