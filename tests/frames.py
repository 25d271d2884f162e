"""Small inputs and shared helpers for the tests."""

from datetime import datetime

import __spark_entry__ as contract

from vestibule.sources import schemas


# The queries of the reports, without those of optional packages.
REGISTERED = [n for n, query in contract.queries().items() if query.__module__ == contract.__name__]


def at(text):
    return datetime.fromisoformat(text)


def event_log(spark, rows):
    """``rows``: (timestamp text, id[, type])."""
    rows = [(at(ts), ident, *(kind or ["INCLUSAO"])) for ts, ident, *kind in rows]
    return spark.createDataFrame(rows, schemas.EVENT_LOG)


def calendar(spark, rows):
    """``rows``: (date text, ISO weekday, holiday flag text)."""
    return spark.createDataFrame(rows, schemas.CALENDAR)


def clients(spark, rows):
    """``rows``: (created, updated or None, profile[, person type])."""
    rows = [
        (at(made), updated and at(updated), profile, *(kind or ["F"]))
        for made, updated, profile, *kind in rows
    ]
    return spark.createDataFrame(rows, schemas.CLIENTS)


def tuples(df):
    return [tuple(row) for row in df.collect()]


def physical(df):
    """The plan before execution, with the scans' full details."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scanned_rows(df):
    """Rows that the file scans of a finished query handed on."""
    plan = df._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total
