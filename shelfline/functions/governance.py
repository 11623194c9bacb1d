"""Governed reads: personal-data tags, column masks and row filters by the caller's groups.

The rules hold for callers who read through :class:`GovernedReader`. Whoever can open the files
can read them unmasked; protecting those is the storage's task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.functions.scalars import EMAIL_MASK, EMAIL_PATTERN, mask_email, mask_name

# The groups the rules ask for, the one country others may see, the tags.
PII_GROUP = "pii_access"
ADMIN_GROUP = "data_admin"
FILTER_COUNTRY = "Germany"
CUSTOMER_TAGS = {
    "email": {"pii": "true", "pii_type": "email"},
    "first_name": {"pii": "true", "pii_type": "name"},
    "last_name": {"pii": "true", "pii_type": "name"},
}

MASKS_BY_TYPE: dict[str, Callable[[Column], Column]] = {"email": mask_email, "name": mask_name}


def tag_columns(df: DataFrame, tags: dict[str, dict[str, str]]) -> DataFrame:
    """Attach tags to columns; they travel with the column through selects, filters and Parquet."""
    for column, values in tags.items():
        df = df.withMetadata(column, {**df.schema[column].metadata, **values})
    return df


def tagged_columns(df: DataFrame) -> dict[str, str]:
    """Columns tagged as personal data, with their kind."""
    return {
        f.name: f.metadata.get("pii_type", "") for f in df.schema.fields if f.metadata.get("pii") == "true"
    }


def mask_tagged(df: DataFrame) -> DataFrame:
    """Mask every column that is tagged as personal data, by the kind on its tag.

    A kind without a mask of its own is blanked, so a new tag hides a column before anyone has
    written a mask for it.
    """
    blank: Callable[[Column], Column] = lambda column: F.lit(None).cast("string")
    masks = {c: MASKS_BY_TYPE.get(kind, blank)(F.col(c)) for c, kind in tagged_columns(df).items()}
    return df.withColumns(masks) if masks else df


@dataclass(frozen=True)
class Policy:
    """What is bound to one table: masks by column, and a filter for non-admins."""

    masks: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    row_filter: Callable[[], Column] | None = None
    mask_by_tags: bool = False


def country_filter(country: str = FILTER_COUNTRY) -> Column:
    """Rows that callers outside the admin group may see."""
    return F.col("ship_country") == country


def sql_text(value: str) -> str:
    """A value as a SQL string, whatever quotes and backslashes it holds."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


class GovernedReader:
    """Reads tables as one principal.

    The principal's groups are looked up once, so that each rule is a constant in the plan: the
    row filter reaches the file scan, and a privileged read has no trace of a mask.
    """

    def __init__(self, principal: str, memberships: DataFrame, policies: dict[str, Policy]):
        self.principal = principal
        self.policies = policies
        self._mine = memberships.filter(F.col("principal") == principal)
        self._known: dict[str, bool] = {}

    def is_member(self, group: str) -> bool:
        if group not in self._known:
            self._known[group] = not self._mine.filter(F.col("group") == group).isEmpty()
        return self._known[group]

    def read(self, name: str, table: DataFrame) -> DataFrame:
        """The table as the principal may see it, rows first, then columns."""
        policy = self.policies.get(name, Policy())
        if policy.row_filter and not self.is_member(ADMIN_GROUP):
            table = table.filter(policy.row_filter())
        if not self.is_member(PII_GROUP):
            if policy.masks:
                table = table.withColumns({c: mask(F.col(c)) for c, mask in policy.masks.items()})
            if policy.mask_by_tags:
                table = mask_tagged(table)
        return table

    def register(self, spark: SparkSession, country: str = FILTER_COUNTRY) -> None:
        """The two policy functions for this principal, for use in SQL text."""
        visible = "true" if self.is_member(ADMIN_GROUP) else f"ship_country = {sql_text(country)}"
        masked = f"regexp_replace(email, r'{EMAIL_PATTERN}', '{EMAIL_MASK}')"
        body = "email" if self.is_member(PII_GROUP) else masked
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION mask_email(email STRING) RETURNS STRING RETURN {body}")
        spark.sql(
            "CREATE OR REPLACE TEMPORARY FUNCTION filter_by_country(ship_country STRING) "
            f"RETURNS BOOLEAN RETURN {visible}"
        )


def rows_of_principal(rows: DataFrame, country: str, principal: str, lookup: DataFrame) -> DataFrame:
    """Rows of the countries that a (principal, country) table grants to the principal."""
    granted = lookup.filter(F.col("principal") == principal).select(F.col("country").alias(country))
    return rows.join(granted, country, "left_semi")
