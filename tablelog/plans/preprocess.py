"""The user's own Spark SQL, in steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

Step = tuple[str, str | None]

# Fixed values of the step language.
ENGINE = "sparkSQL"
INPUT = "input"
OUTPUT = "output"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class SqlFunction:
    """A function of the user's own in SQL, which the optimizer puts in place of its calls.

    ``parameters`` and ``returns`` are types as in DDL. A function that returns ``TABLE (...)`` has a query
    as its body and is called in FROM; any other has an expression.
    """

    name: str
    parameters: str
    returns: str
    body: str

    def declare(self, spark: SparkSession) -> None:
        """Make the function known to this session; a taken name is refused."""
        spark.sql(f"CREATE TEMPORARY FUNCTION {_quoted(self.name)}({self.parameters}) RETURNS {self.returns} RETURN {self.body}")


def preprocess(df: DataFrame, steps: Sequence[Step], engine: str | None = ENGINE, shared: list[DataFrame] | None = None) -> DataFrame:
    """Run SQL steps ``(query, alias)`` over the view ``input``.

    A step with an alias becomes a view for later steps; the first one without an alias, or
    with alias ``output``, is the result. The views exist only while the steps are analysed,
    and a name already taken in the session is refused rather than replaced.

    Steps are expanded where they are read, so one read twice would run twice. With a list as
    ``shared`` those (and ``input``) are kept on the executors and put on the list, for the
    caller to release when the result is written.
    """
    if not steps:
        return df
    if engine is None:
        raise ValueError("SQL steps are given but no engine")
    if engine != ENGINE:
        raise ValueError(f"Unsupported engine: {engine}")
    spark = df.sparkSession
    views: dict[str, DataFrame] = {}

    def register(frame: DataFrame, name: str) -> None:
        frame.createTempView(_quoted(name))
        views[name] = frame

    result = None
    try:
        register(df, INPUT)
        for query, alias in steps:
            step = spark.sql(query)
            if alias is None or alias == OUTPUT:
                # Analysed already: the plan no longer needs the views.
                step.schema
                result = step
                break
            register(step, alias)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)
    if result is None:
        raise ValueError("No step produces the output")
    if shared is not None:  # not before: a view that is dropped takes what is kept of it along
        shared.extend(_keep_shared(result, views))
    return result


def _keep_shared(result: DataFrame, views: dict[str, DataFrame]) -> list[DataFrame]:
    """Persist the views that the plan of ``result`` reads more than once.

    Later steps come first: once a step is kept, what it reads is read once for it.
    """
    kept: dict[str, DataFrame] = {}
    plan = result._jdf.queryExecution().analyzed()
    for name in reversed(views):
        if _reads(plan, name, set(kept)) + sum(_reads(v._jdf.queryExecution().analyzed(), name, set(kept)) for v in kept.values()) > 1:
            kept[name] = views[name].persist(StorageLevel.MEMORY_AND_DISK)
    return list(kept.values())


def _reads(plan, name: str, kept: set[str]) -> int:
    """How often an analysed plan reads a view, not counting what views that are kept read."""
    found = 0
    if plan.getClass().getSimpleName() == "View":
        own = plan.desc().identifier().table()
        if own == name:
            return 1
        if own in kept:
            return 0
    children = plan.children()
    for i in range(children.size()):
        found += _reads(children.apply(i), name, kept)
    inner = plan.subqueries()
    for i in range(inner.size()):
        found += _reads(inner.apply(i), name, kept)
    return found
