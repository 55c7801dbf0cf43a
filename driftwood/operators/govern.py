"""Governance as table operators: row filters, column masks, dynamic views
over a membership table, tag-driven masks, recipient-specific exports,
subject erasure and personal-data vault split.

Policies are SQL expressions evaluated by Catalyst (no Python per row), so
filters on unmasked columns still reach the Parquet scan. Order: row filter
first, then masks. One filter per table, one mask per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwood.functions import masks


@dataclass
class Policy:
    row_filter: str | Column | None = None
    masks: Mapping[str, str | Column] = field(default_factory=dict)


def _e(x):
    return F.expr(x) if isinstance(x, str) else x


def secured_read(df: DataFrame, policy: Policy) -> DataFrame:
    """Apply a table policy: the row filter, then the column masks."""
    if policy.row_filter is not None:
        df = df.filter(F.coalesce(_e(policy.row_filter), F.lit(False)))
    if policy.masks:
        df = df.withColumns({c: _e(m) for c, m in policy.masks.items()})
    return df


def is_member(members: DataFrame, group: str, user_col: str = "user_name", group_col: str = "group_name",
              user: Column | None = None) -> Column:
    """Boolean column: is the session user (``current_user()``) in ``group``?
    Evaluated once as a scalar subquery over the membership table."""
    who = user if user is not None else F.current_user()
    hit = members.filter((F.col(user_col) == who) & (F.col(group_col) == F.lit(group)))
    return hit.select(F.count(F.lit(1)) > 0).scalar()


def tag_masks(df: DataFrame, tags: DataFrame, tag: str = "pii", column_col: str = "column_name",
              tag_col: str = "tag", value_col: str = "value") -> dict[str, Column]:
    """Masks derived from a tag table: every column tagged ``tag = true`` is
    redacted (strings) or nulled (other types). Tags are per column (bounded)."""
    tagged = {r[0] for r in tags.filter((F.col(tag_col) == tag) & (F.lower(F.col(value_col)) == "true"))
              .select(column_col).collect()}
    out = {}
    for f in df.schema.fields:
        if f.name in tagged:
            out[f.name] = (masks.redact(f.name) if f.dataType.simpleString() == "string"
                           else F.lit(None).cast(f.dataType))
    return out


def share_export(df: DataFrame, path: str, recipient_filter: str | Column | None = None,
                 columns: Sequence[str] | None = None) -> str:
    """Recipient-specific read-only copy: filtered rows and shared columns
    written as Parquet (snapshot)."""
    out = df if recipient_filter is None else df.filter(F.coalesce(_e(recipient_filter), F.lit(False)))
    if columns:
        out = out.select(*columns)
    out.write.mode("overwrite").parquet(path)
    return path


def erase_subject(vault: DataFrame, silver: DataFrame, subject, vault_key: str, silver_key: str,
                  pii_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Right to erasure: NULL the subject's personal columns in the vault and
    drop the subject's rows from silver. Returns the two rewritten tables."""
    is_subj = _is_subject(vault_key, subject)
    v = vault.withColumns({c: F.when(is_subj, F.lit(None).cast(vault.schema[c].dataType)).otherwise(F.col(c))
                           for c in pii_cols})
    return v, silver.filter(~_is_subject(silver_key, subject))


def _is_subject(key: str, subject) -> Column:
    return F.coalesce(F.col(key) == (subject if isinstance(subject, Column) else F.lit(subject)), F.lit(False))


def erasure_report(tables: dict[str, tuple[DataFrame, str, str]], subject) -> DataFrame:
    """What an erasure touches: for each table (name -> (table, key column, action)) its rows and those of the subject."""
    out = None
    for name, (df, key, action) in tables.items():
        r = df.agg(F.count(F.lit(1)).alias("table_rows"), F.count_if(_is_subject(key, subject)).alias("rows_touched"))
        r = r.select(F.lit(name).alias("table_name"), F.lit(action).alias("action"), "table_rows", "rows_touched")
        out = r if out is None else out.unionByName(r)
    return out


def vault_split(facts: DataFrame, people: DataFrame, fact_key: str, people_key: str, secret: bytes,
                ref_col: str = "customer_ref") -> tuple[DataFrame, DataFrame]:
    """Replace the person key in facts by a keyed one-way digest (HMAC-SHA-256) and keep
    the personal columns in a separate vault under the same reference."""
    bronze = facts.withColumn(ref_col, masks.keyed_digest(fact_key, secret)).drop(fact_key)
    vault = people.withColumn(ref_col, masks.keyed_digest(people_key, secret)).drop(people_key)
    return bronze, vault
