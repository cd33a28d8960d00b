import contextlib
import io
import re

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    """All rows as tuples, in an order that does not depend on the plan."""
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def final_plan(df: DataFrame) -> str:
    """The plan that was really run, after adaptive changes."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def count_of(text: str, pattern: str) -> int:
    return len(re.findall(pattern, text))
