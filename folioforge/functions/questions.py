"""Question text of an annotation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def question_in_year(question: Column, add_year: Column, year: Column) -> Column:
    """Questions marked so end in `in year <year>?`; a numeric year loses its decimals."""
    whole_year = F.coalesce(year.try_cast("double").try_cast("bigint").cast("string"), year)
    dated = F.concat(
        F.substring_index(question, "?", 1), F.lit(" in year "), whole_year, F.lit("?")
    )
    return F.when(add_year, dated).otherwise(question)
