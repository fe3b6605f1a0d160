"""Read-only SQL over registered views: one SELECT or WITH, no side effects, bounded answers."""

from __future__ import annotations

import re
import threading
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

DEFAULT_ROWS, MAX_ROWS, MAX_BYTES, TIMEOUT_S = 200, 1_000, 1_000_000, 30
# Words that no read-only query holds outside of literals.
FORBIDDEN = (
    "insert", "update", "delete", "merge", "create", "drop", "alter", "truncate", "grant", "revoke", "attach", "detach", "copy", "export", "import",
    "install", "load", "call", "set", "reset", "pragma", "vacuum", "checkpoint", "use", "add", "refresh", "cache", "uncache", "reflect", "java_method",
)


class Rejected(ValueError):
    """The text isn't a single read-only query over allowed views."""


# What isn't code: comments, literals (with doubled or escaped quotes) and quoted names; and what an open one begins with.
_QUIET = re.compile(r"""(?P<gap>--[^\n]*|/\*.*?\*/)|'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|(?P<name>`(?:[^`]|``)*`)|(?P<open>/\*|['"`])""", re.S)


def bare_code(sql: str) -> str:
    """The text with comments as blanks, literals as '' and quoted names as ``."""

    def quiet(m: re.Match) -> str:
        if m["open"]:
            raise Rejected("open comment or quote")
        return " " if m["gap"] else "``" if m["name"] else "''"

    return _QUIET.sub(quiet, sql).strip()


def validate(sql: str) -> str:
    """The query without its final semicolon; raises Rejected."""
    bare = bare_code(sql).rstrip(";").strip()
    if not bare or ";" in bare:
        raise Rejected("exactly one statement is allowed")
    if not re.match(r"(?i)(select|with)\b", bare):
        raise Rejected("only SELECT or WITH")
    if hit := re.search(rf"(?i)\b({'|'.join(FORBIDDEN)})\b", bare):
        raise Rejected(f"{hit[0]} is not allowed")
    if re.search(r"\.\s*``", bare):
        raise Rejected("files are not tables here")
    return sql.strip().rstrip(";")


@dataclass
class Answer:
    columns: list[str]
    rows: list[list]
    truncated: bool


class Sandbox:
    def __init__(self, spark: SparkSession, views: set[str]):
        self.spark, self.views = spark, {v.lower() for v in views}

    def plan(self, sql: str) -> DataFrame:
        """The whole query as a DataFrame. What it reads is taken from the analysed plan, where WITH names are resolved by their scope."""
        text = validate(sql)
        try:
            df = self.spark.sql(text)
        except AnalysisException as e:  # unknown names and bad syntax
            raise Rejected(str(e).split("\n")[0]) from None
        for name in self._read(df._jdf.queryExecution().analyzed()):
            if name.lower() not in self.views:
                raise Rejected(f"{name} is not a known view")
        return df

    @staticmethod
    def _read(plan) -> set[str]:
        """Names of the outermost views and tables in an analysed plan, those in subqueries too."""
        found: set[str] = set()
        todo = [plan]
        while todo:
            node = todo.pop()
            kind = node.getClass().getSimpleName()
            if kind == "View":
                found.add(node.desc().identifier().table())
                continue
            if kind in ("LogicalRelation", "HiveTableRelation", "DataSourceV2Relation", "StreamingRelation", "LogicalRDD"):
                found.add(node.simpleString(80))  # a source that no view stands before
            for part in (node.children(), node.innerChildren(), node.subqueries()):
                todo += [part.apply(k) for k in range(part.size())]
        return found

    def query(self, sql: str, max_rows: int = DEFAULT_ROWS, timeout_s: float = TIMEOUT_S) -> Answer:
        """The first rows that fit in MAX_BYTES; the cap is part of the plan, so that no more reaches the driver."""
        limit = max(1, min(max_rows, MAX_ROWS))
        plan = self.plan(sql)
        few = plan.limit(limit + 1).toDF(*[f"c{k}" for k in range(len(plan.columns))])
        line = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)  # limit + 1 rows at most
        sized = few.select(F.struct("*").alias("row"), F.octet_length(F.to_json(F.struct("*"))).alias("size"), F.monotonically_increasing_id().alias("k"))
        sized = sized.select("row", "size", "k", F.sum("size").over(line).alias("total"), F.count("*").over(line).alias("n"))
        fits = (F.col("total") <= MAX_BYTES) & (F.col("n") <= limit)
        df = sized.where(F.col("total") - F.col("size") <= MAX_BYTES).select(F.when(fits, F.col("row")).alias("row"))
        context, group = self.spark.sparkContext, f"sandbox-{uuid.uuid4().hex}"
        context.setJobGroup(group, "sandbox", interruptOnCancel=True)
        timer = threading.Timer(timeout_s, lambda: context.cancelJobGroup(group))
        timer.start()
        try:
            found = df.collect()
        finally:
            timer.cancel()
            context.setLocalProperty("spark.jobGroup.id", None)
        rows = [list(r["row"]) for r in found if r["row"] is not None]
        return Answer(plan.columns, rows, len(rows) < len(found))
