"""User profile documents: demographics of the user and one profile row per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.functions.scalars import empty_to_null, lowercase_or_null, parse_date_or_null
from pulsemill.operators.documents import (
    ORIGIN,
    Decoded,
    any_unfit,
    columns_of,
    failures,
    parse,
    struct_ddl,
    unreadable,
)

_DATA = struct_ddl([*fl.USER_DATA, "birthDate"])
PROFILE = f"full_name string, userData struct<{_DATA}>"


def project_user_profile(docs: DataFrame) -> DataFrame:
    """The profile row; its id is derived from its origin, so that a retry gives the same id."""
    columns = [
        lowercase_or_null(c).alias("gender") if f.column == "gender" else c
        for f, c in zip(fl.USER_DATA, columns_of("doc.userData", fl.USER_DATA))
    ]
    return parse(docs, PROFILE).select(
        *ORIGIN,
        F.lit(0).alias("pos"),
        F.xxhash64("user_id", "file_set_ts", "file_name").alias("user_profile_id"),
        "user_id",
        *columns,
    )


def project_demographics(docs: DataFrame) -> DataFrame:
    return parse(docs, "full_name string, userData struct<birthDate: string>").select(
        *ORIGIN,
        F.lit(0).alias("pos"),
        "user_id",
        F.col("doc.full_name").alias("full_name"),
        parse_date_or_null(F.col("doc.userData.birthDate")).alias("birth_date"),
    )


def _bad_birth_date() -> Column:
    stated = empty_to_null(F.col("doc.userData.birthDate"))
    return stated.isNotNull() & ~(stated.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$") & stated.try_cast("date").isNotNull())


def profile_failures(docs: DataFrame) -> DataFrame:
    docs = parse(docs, PROFILE)
    return failures(
        docs,
        {
            "unreadable document": unreadable(docs),
            "userData missing": F.col("doc.userData").isNull(),
            "bad birth date": _bad_birth_date(),
            "bad profile value": any_unfit("doc.userData", fl.USER_DATA),
        },
    )


def decode_user_profile(docs: DataFrame) -> Decoded:
    rows = {"user_profile": project_user_profile(docs), "user.demographics": project_demographics(docs)}
    return Decoded(rows, [profile_failures(docs)])
