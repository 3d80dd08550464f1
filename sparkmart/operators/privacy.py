"""Privacy: hashing, masking, erasure. Column policies live in StructField metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sparkmart.functions import as_col, salted_hash

# What a masked or erased value looks like.
MASKED = "***MASKED***"
REDACTED = "GDPR Redacted"


def tag(df: DataFrame, **meta: dict) -> DataFrame:
    """Attach metadata to columns: tag(df, email={'sensitive': True})."""
    for name, m in meta.items():
        df = df.withMetadata(name, m)
    return df


def salt_for(column: str, salts: dict) -> str:
    """Salt by the kind of value the column name announces: name, email, ip or other."""
    for kind in ("name", "email", "ip"):
        if kind in column.lower():
            return salts[kind]
    return salts["other"]


def hash_col(column: str, salts: dict) -> Column:
    return salted_hash(column, salt_for(column, salts)).alias(f"{column.lower()}_hash")


def _sensitive(df) -> list[str]:
    return [f.name for f in df.schema.fields if f.metadata.get("sensitive")]


def hash_sensitive(df, salts) -> DataFrame:
    """Sensitive columns replaced by their hash, the others unchanged."""
    flagged = set(_sensitive(df))
    return df.select(*[hash_col(c, salts) if c in flagged else F.col(c) for c in df.columns])


def sensitive_only(df, key, salts) -> DataFrame:
    """Companion table: hashed join key and the sensitive columns in clear."""
    return df.select(hash_col(key, salts), *_sensitive(df))


def mask_value(dtype: T.DataType) -> Column:
    """Typed stand-in for a masked value."""
    if isinstance(dtype, T.StringType):
        return F.lit(MASKED)
    if isinstance(dtype, T.ArrayType):
        return F.array(F.lit(MASKED)).cast(dtype) if isinstance(dtype.elementType, T.StringType) else F.lit(None).cast(dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.lit(0.0).cast(dtype)
    if isinstance(dtype, (T.IntegralType, T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.VariantType):
        return F.to_variant_object(F.array(F.lit(MASKED)))
    return F.lit(None).cast(dtype)


def mask(df, roles, always=("transformer", "loader")) -> DataFrame:
    """Columns with a 'masking_policy' are readable to that policy's role only."""
    roles = set(roles)
    out = []
    for f in df.schema.fields:
        policy = f.metadata.get("masking_policy")
        hidden = policy and policy not in roles and not roles & set(always)
        out.append(mask_value(f.dataType).alias(f.name) if hidden else F.col(f.name))
    return df.select(*out)


def _matches(email_cols, email_sha) -> Column:
    """True where any e-mail column hashes to a subject's hash. Hashes are compared as
    literals: a request names a handful of subjects; use `subjects` for a table of them."""
    hit = F.lit(False)
    for c in email_cols:
        hit = hit | F.coalesce(F.sha2(F.trim(F.lower(as_col(c))), 256).isin(*email_sha), F.lit(False))
    return hit


def erase(df, email_sha, email_cols) -> DataFrame:
    """Rows of the subjects removed."""
    return df.filter(~_matches(email_cols, email_sha))


def erase_subjects(df, subjects, email_cols) -> DataFrame:
    """Erasure by a table of subject hashes (column `email_sha`): one anti join per column."""
    for c in email_cols:
        df = df.join(subjects.select("email_sha"), F.sha2(F.trim(F.lower(as_col(c))), 256) == F.col("email_sha"), "left_anti")
    return df


def redact(df, email_sha, email_cols, text_cols) -> DataFrame:
    """Snapshot rows of the subjects kept, with texts redacted and e-mails hashed."""
    hit = _matches(email_cols, email_sha)
    sha = None
    for c in email_cols:
        h = F.sha2(F.trim(F.lower(as_col(c))), 256)
        one = F.when(h.isin(*email_sha), h)
        sha = one if sha is None else F.coalesce(sha, one)
    out = df.withColumn("__hit", hit).withColumn("__sha", sha)
    for c in text_cols:
        out = out.withColumn(c, F.when(F.col("__hit"), REDACTED).otherwise(F.col(c)))
    for c in email_cols:
        out = out.withColumn(c, F.when(F.col("__hit"), F.col("__sha")).otherwise(F.col(c)))
    return out.drop("__hit", "__sha")
