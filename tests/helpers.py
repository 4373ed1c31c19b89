"""What several test files use."""


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
