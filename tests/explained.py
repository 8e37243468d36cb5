"""Plans as text, for tests of what a query reads and shuffles."""


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
