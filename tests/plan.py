"""Look at executed plans."""


def final_plan(df):
    """Text of the plan that actually ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def static_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)
