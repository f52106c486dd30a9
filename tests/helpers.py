"""Small helpers for hand-written rows."""

import datetime as dt


def ts(text: str | None):
    return None if text is None else dt.datetime.fromisoformat(text)


def rows(df, *cols):
    out = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
