"""Column catalogue, classification, masking, drift, run report."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.sets import two_way_difference

# Sensitive-name keywords, categories in order of precedence. A keyword matches anywhere
# in a lower-cased column name; a name in SKIP_NAMES is never classified.
SKIP_NAMES = ["product_name"]
KEYWORDS = {
    "PII_MASKING": [
        "name", "first_name", "last_name", "full_name", "email", "phone", "mobile", "address", "street",
        "city", "state", "zipcode", "zip_code", "postal_code", "date_of_birth", "dob",
    ],
    "FINANCIAL_MASKING": [
        "account_number", "bank_account", "credit_card", "card_number", "debit_card", "cvv", "cvc", "iban",
        "swift", "routing_number", "salary", "income", "balance", "payment", "transaction", "amount",
        "price", "cost", "total", "discount", "tax",
    ],
    "CREDENTIAL_MASKING": [
        "password", "passwd", "passcode", "pin", "secret", "api_key", "apikey", "access_token",
        "refresh_token", "auth_token", "authorization", "private_key", "client_secret",
    ],
    "IDENTIFIER_MASKING": [
        "national_id", "citizen_id", "passport", "driver_license", "social_security", "tax_id",
    ],
    "HEALTH_MASKING": [
        "medical", "patient", "diagnosis", "disease", "medication", "prescription", "blood_type", "health",
    ],
}
RULES = {label: "|".join(words) for label, words in KEYWORDS.items()}  # patterns, in the same order
SAMPLE_ROWS = 100
# A declared model. Checks are found under either of two keys; one with parameters comes as its JSON text.
DECLARED = "name string, columns array<struct<name string, tests array<string>, data_tests array<string>>>"

CATALOGUE = (
    "table_catalog string, table_schema string, table_name string, column_name string, data_type string, "
    "description string"
)


def catalogue(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    descriptions: Mapping[tuple[str, str], str] | None = None,
    catalog: str = "spark_catalog",
    schema: str = "default",
) -> DataFrame:
    """One row per column of the given frames (schemas only, nothing is scanned)."""
    described = descriptions or {}
    rows = [
        (catalog, schema, table, field.name, field.dataType.simpleString(), described.get((table, field.name)))
        for table, df in tables.items()
        for field in df.schema.fields
    ]
    return spark.createDataFrame(rows, CATALOGUE)


def with_descriptions(columns: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Catalogue rows with the description found under the same catalog, schema, table and column."""
    keys = ["table_catalog", "table_schema", "table_name", "column_name"]
    return columns.drop("description").join(descriptions.select(*keys, "description"), keys, "left")


def category_of(name: str) -> str | None:
    """Category of one column name, for planning a projection."""
    lowered = name.lower()
    fitting = (label for label, pattern in RULES.items() if re.search(pattern, lowered))
    return None if lowered in SKIP_NAMES else next(fitting, None)


def category(name: Column) -> Column:
    """Category of column names held as data; null for harmless ones."""
    lowered = F.lower(name)
    fitting = F.coalesce(*[F.when(lowered.rlike(pattern), label) for label, pattern in RULES.items()])
    return F.when(~lowered.isin(SKIP_NAMES), fitting)


def classify(columns: DataFrame) -> DataFrame:
    return columns.withColumn("category", category(F.col("column_name")))


def mask(df: DataFrame) -> DataFrame:
    """Every value of a classified column, nulls included, becomes ``MASKED_<category>``.

    The masked columns are constants, so the scan does not even read them.
    """
    found = {c: category_of(c) for c in df.columns}
    return df.withColumns({c: F.lit(f"MASKED_{label}") for c, label in found.items() if label})


def as_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def sample(df: DataFrame, order: Sequence[str] = (), rows: int = SAMPLE_ROWS) -> DataFrame:
    """Up to ``rows`` rows as text: any rows, or the first in a given order."""
    return as_text((df.orderBy(*order) if order else df).limit(rows))


class DriftError(RuntimeError):
    """A frozen schema or check set has changed; ``changes`` has every change."""

    def __init__(self, message: str, changes: DataFrame):
        super().__init__(message)
        self.changes = changes


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per level (model, column): counts before and after, numbers added and removed.

    Inputs have ``model`` and ``column``; a model without columns has a null column.
    """

    def level(name: str, columns: list[str]) -> DataFrame:
        flagged = _flag(before, after, columns)
        return flagged.agg(
            F.count_if("was").alias("before_count"),
            F.count_if("is_now").alias("after_count"),
            F.count_if(F.col("is_now") & ~F.col("was")).alias("added"),
            F.count_if(F.col("was") & ~F.col("is_now")).alias("removed"),
        ).select(F.lit(name).alias("level"), "*")

    return level("model", ["model"]).unionByName(level("column", ["model", "column"]))


def _flag(before: DataFrame, after: DataFrame, columns: list[str]) -> DataFrame:
    both = before.select(*columns, F.lit(True).alias("was"), F.lit(False).alias("is_now")).unionByName(
        after.select(*columns, F.lit(False).alias("was"), F.lit(True).alias("is_now"))
    )
    return both.groupBy(*columns).agg(F.bool_or("was").alias("was"), F.bool_or("is_now").alias("is_now"))


def changed_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    return two_way_difference(before, after, ["model", "column"])


def changed_checks(before: DataFrame, after: DataFrame) -> DataFrame:
    return two_way_difference(before, after, ["model", "column", "test"])


def require_kept_schema(before: DataFrame, after: DataFrame) -> None:
    """Raise when a frozen schema lost a model or a column; additions are allowed."""
    lost = changed_columns(before, after).filter("status = 'removed'")
    _raise_on(lost, "models or columns were removed")


def require_same_checks(before: DataFrame, after: DataFrame) -> None:
    """Raise when a frozen check set changed at all."""
    _raise_on(changed_checks(before, after), "checks were added or removed")


def _raise_on(changes: DataFrame, what: str) -> None:
    counts = changes.groupBy("status").count().orderBy("status").collect()
    if counts:
        raise DriftError(f"{what}: {', '.join(f'{row[1]} {row[0]}' for row in counts)}", changes)


def _declared_columns(declared: DataFrame, text: str) -> DataFrame:
    """``model, column``: a row per declared column with its ``name`` and checks, null for a model without columns."""
    parsed = declared.select(F.from_json(text, DECLARED, {"mode": "FAILFAST"}).alias("model"))
    return parsed.select(F.col("model.name").alias("model"), F.explode_outer("model.columns").alias("column"))


def captured_schema(declared: DataFrame, text: str = "value") -> DataFrame:
    """``model, column`` of declared models, one JSON object in each row of ``text``."""
    return _declared_columns(declared, text).select("model", F.col("column.name").alias("column"))


def captured_checks(declared: DataFrame, text: str = "value") -> DataFrame:
    """``model, column, test`` of declared models; a test with parameters is JSON text with its keys in order."""
    both = F.concat(*[F.coalesce(f"column.{key}", F.array().cast("array<string>")) for key in ("tests", "data_tests")])
    tests = _declared_columns(declared, text).select("model", F.col("column.name").alias("column"), F.explode(both).alias("test"))
    return tests.withColumn("test", F.when(F.col("test").startswith("{"), F.to_json(F.parse_json("test"))).otherwise(F.col("test")))


def run_report(steps: Sequence[tuple[str, DataFrame | None]]) -> DataFrame:
    """One row per step: its status, the rows and columns it produced; a step without a result is UNKNOWN."""
    spark = next(df.sparkSession for _, df in steps if df is not None)
    parts = []
    for name, df in steps:
        if df is None:
            parts.append(spark.range(1).select(
                F.lit(name).alias("step"), F.lit("UNKNOWN").alias("status"),
                F.lit(None).cast("bigint").alias("records"), F.lit(None).cast("bigint").alias("columns")))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("records")).select(
                F.lit(name).alias("step"), F.lit("SUCCESS").alias("status"), "records",
                F.lit(len(df.columns)).cast("bigint").alias("columns")))
    return reduce(DataFrame.unionByName, parts)


def write_report(report: DataFrame, path: str) -> None:
    """The report as one JSON file (a row per step)."""
    report.coalesce(1).write.mode("overwrite").json(path)
