"""Looking at plans."""

from __future__ import annotations


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def same_rows(left, right) -> bool:
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def largest_method(df) -> int:
    """Bytes of the largest method of the generated code. The JVM does not compile one beyond 8000."""
    debug = getattr(getattr(df.sparkSession._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length()))
