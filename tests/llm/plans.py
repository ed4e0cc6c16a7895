import re


def assert_native(df):
    """No Python in the plan that will run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan), plan[:2000]
