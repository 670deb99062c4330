"""Reading physical plans in tests."""


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *order):
    return sorted([tuple(r) for r in df.collect()], key=repr) if not order else [
        tuple(r) for r in df.orderBy(*order).collect()
    ]
