"""The cleaning functions under their SQL names, for ad-hoc queries.

They are SQL functions, which Spark inlines into the plan like built-in ones.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from namelens.functions import text

_DIGITS = f"regexp_replace(raw, '{text.NO_DIGITS}', '')"
_GENDERS = " ".join(
    f"when upper(trim(raw)) in ({', '.join(repr(s) for s in spellings)}) then '{gender}'"
    for gender, spellings in text.GENDER_SPELLINGS.items()
)

SQL_FUNCTIONS = {
    "normalize_name": f"nullif(regexp_replace(lower(trim(raw)), '{text.NO_ASCII_LETTERS}', ''), '')",
    "normalize_zip5": f"if(length({_DIGITS}) >= {text.ZIP_DIGITS}, left({_DIGITS}, {text.ZIP_DIGITS}), null)",
    "normalize_gender": f"case {_GENDERS} end",
}


def register_functions(spark: SparkSession) -> None:
    """Make ``normalize_name``, ``normalize_zip5`` and ``normalize_gender`` callable in SQL."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(
            f"create or replace temporary function {name}(raw string)"
            f" returns string return {body}"
        )
