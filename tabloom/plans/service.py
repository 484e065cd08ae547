"""A read-only SQL service over registered views.

What isn't known to be harmless is refused, by lists of what is allowed. The parsed
statement may hold only listed kinds of nodes, tables that are registered or named in
its own WITH, and built-in functions that compute from their arguments: some statements
would run while they are analysed, and some names are only known by analysis. Then the
analysed plan, in which every name is resolved, may hold only listed classes of nodes
and expressions above the registered views. Last, the bytes that the optimised plan
reads, the rows and bytes of the result, and the time are bounded.
"""

from __future__ import annotations

import base64
import datetime
import decimal
import math
import re
import threading
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DEFAULT_ROWS, MOST_ROWS = 25, 500
DEFAULT_TIMEOUT_S = 790.0


#: Groups of built-in functions that only compute from their arguments, and single ones of other groups.
FUNCTION_GROUPS = (
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs datetime_funcs generator_funcs hash_funcs json_funcs "
    "lambda_funcs map_funcs math_funcs predicate_funcs string_funcs struct_funcs url_funcs variant_funcs window_funcs xml_funcs"
).split()
FUNCTIONS = ("typeof", "equal_null")
#: Nodes that a parsed statement may have, beside those of analysed plans.
PARSED_NODES = (
    "UnresolvedWith UnresolvedRelation UnresolvedTableValuedFunction UnresolvedTVFAliases UnresolvedInlineTable UnresolvedSubqueryColumnAliases UnresolvedHaving "
    "UnresolvedHint Pivot Unpivot WithWindowDefinition"
).split()
#: Nodes that read, combine or compute. A View is looked at by its name only: what registered views read is the service's own choice.
NODES = (
    "Project Filter Aggregate Sort GlobalLimit LocalLimit Tail Offset Join LateralJoin Union Intersect Except Distinct Deduplicate SubqueryAlias Generate Sample Window Expand "
    "ResolvedHint WithCTE CTERelationDef CTERelationRef UnionLoop UnionLoopRef OneRowRelation LocalRelation Range PipeOperator View"
).split()
#: Names and forms that analysis resolves.
PARSED_EXPRESSIONS = (
    "UnresolvedAttribute UnresolvedStar UnresolvedFunction UnresolvedGenerator UnresolvedAlias UnresolvedExtractValue UnresolvedNamedLambdaVariable UnresolvedOrdinal UnresolvedWindowExpression "
    "UnresolvedSubqueryColumnAliases UnresolvedStarExcept UnresolvedStarExceptOrReplace UnresolvedInlineTable MultiAlias"
).split()
#: Expressions that stand for no function of their own: names, values, windows, subqueries, groupings, access to nested values, and date arithmetic.
EXPRESSIONS = (
    "Alias AttributeReference OuterReference Literal Cast SortOrder NamedLambdaVariable LambdaFunction ScalarSubquery ListQuery Exists InSubquery LateralSubquery "
    "AggregateExpression WindowExpression WindowSpecDefinition SpecifiedWindowFrame UnspecifiedFrame$ UnboundedPreceding$ UnboundedFollowing$ CurrentRow$ PivotFirst Cube Rollup GroupingSets GroupingID Grouping "
    "GetArrayItem GetMapValue GetStructField GetArrayStructFields GetViewColumnByNameAndOrdinal UpCast CreateNamedStruct KnownNotNull KnownFloatingPointNormalized NormalizeNaNAndZero "
    "DatetimeSub TimestampAddInterval TimeAdd DateAddInterval DateAddYMInterval TimestampAddYMInterval SubtractTimestamps SubtractDates MultiplyDTInterval MultiplyYMInterval MultiplyInterval DivideDTInterval DivideYMInterval DivideInterval "
    "PreciseTimestampConversion ResolvedCollation CheckOverflow MakeDecimal UnscaledValue TryEval LikeAll LikeAny NotLikeAll NotLikeAny In InSet Not EqualNullSafe VirtualColumn PipeExpression Explode PosExplode Inline Stack GeneratorOuter JsonTuple"
).split()
TABLE_FUNCTIONS = ("range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack", "json_tuple")
#: Bytes that a statement may read, by the estimates of its optimised plan, and that its result may have.
INPUT_BYTES, RESULT_BYTES = 1 << 40, 8 << 20


class Refused(ValueError):
    """The statement isn't a query over the registered views."""


def seconds(text: str | float | None, default: float = DEFAULT_TIMEOUT_S) -> float:
    """A duration like '790s', '500ms', '2m' or a plain number of seconds."""
    if text is None or text == "":
        return default
    m = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*(ms|s|m)?\s*", str(text))
    if not m:
        raise ValueError(f"not a duration: {text!r}")
    return float(m[1]) * {"ms": 0.001, "s": 1.0, "m": 60.0, None: 1.0}[m[2]]


def jsonable(x):
    """A value as JSON can hold it."""
    if x is None or isinstance(x, (bool, int, str)):
        return x
    if isinstance(x, float):
        return x if math.isfinite(x) else str(x)
    if isinstance(x, decimal.Decimal):
        return int(x) if x == x.to_integral_value() and abs(x) < 1 << 53 else float(x)
    if isinstance(x, (datetime.datetime, datetime.date, datetime.time)):
        return x.isoformat()
    if isinstance(x, datetime.timedelta):
        return x.total_seconds()
    if isinstance(x, (bytes, bytearray)):
        return base64.b64encode(x).decode()
    if hasattr(x, "asDict"):
        return {k: jsonable(v) for k, v in x.asDict().items()}
    if isinstance(x, dict):
        return {str(k): jsonable(v) for k, v in x.items()}
    if isinstance(x, (list, tuple, set)):
        return [jsonable(v) for v in x]
    return str(x)


class Service:
    """Queries over views; build() registers them in a session and is called again when they are old."""

    def __init__(self, spark: SparkSession, build, notes: dict[str, str] | None = None, refresh_s: float = 300.0, timeout: str | float | None = None, input_bytes: int = INPUT_BYTES, result_bytes: int = RESULT_BYTES):
        self.spark, self.build, self.notes, self.refresh_s = spark.newSession(), build, notes or {}, refresh_s
        self.timeout_s, self.built, self.views = seconds(timeout), 0.0, []
        self.input_bytes, self.result_bytes, self.classes = input_bytes, result_bytes, frozenset()

    def _fresh(self) -> SparkSession:
        if not self.built or time.monotonic() - self.built > self.refresh_s:
            self.views = list(self.build(self.spark))
            self.built = time.monotonic()
        return self.spark

    def list_sources(self) -> list[dict]:
        self._fresh()
        return [{"name": v, "description": self.notes.get(v, "")} for v in self.views]

    def describe_table(self, name: str) -> dict:
        spark = self._fresh()
        if name not in self.views:
            return {"error": f"unknown table {name!r}", "tables": self.views}
        return {"table": name, "columns": [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in spark.table(name).schema]}

    def check(self, sql: str) -> DataFrame:
        """The statement's DataFrame, if all it does is read registered views."""
        if not sql or "\x00" in sql:
            raise Refused("empty statement or null character")
        spark = self._fresh()
        state = spark._jsparkSession.sessionState()
        parsed = state.sqlParser().parsePlan(sql)
        self._parsed(parsed, {v.lower() for v in self.views})
        df = spark.sql(sql)
        query = df._jdf.queryExecution()
        self._analysed(query.analyzed())
        size = sum(int(x.stats().sizeInBytes()) for x in _leaves(query.optimizedPlan()) if _kind(x) != "UnionLoopRef")  # that reads its own loop
        if size > self.input_bytes:
            raise Refused(f"it would read about {size} bytes; {self.input_bytes} are allowed")
        return df

    # the parsed statement

    def _parsed(self, plan, known: set[str]) -> None:
        kind = _kind(plan)
        if kind not in PARSED_NODES and kind not in NODES or kind == "View":
            raise Refused(f"only queries are allowed, not {kind}")
        if kind == "UnresolvedWith":
            known = set(known)
            pairs = [plan.cteRelations().apply(i) for i in range(plan.cteRelations().size())]
            if plan.allowRecursion():
                known |= {p.productElement(0).lower() for p in pairs}
            for p in pairs:  # each sees those before it
                self._parsed(p.productElement(1), known)
                known.add(p.productElement(0).lower())
        elif kind == "UnresolvedRelation":
            parts = _items(plan.multipartIdentifier())
            if len(parts) > 1 or parts[0].lower() not in known:
                raise Refused(f"no such table: {'.'.join(parts)}")
        elif kind == "UnresolvedTableValuedFunction":
            self._allow(plan.name(), TABLE_FUNCTIONS, ())
        for e in _items(plan.expressions()):
            self._parsed_expression(e, known)
        for p in _items(plan.children()):
            self._parsed(p, known)

    def _parsed_expression(self, e, known: set[str]) -> None:
        kind = _kind(e)
        if kind == "UnresolvedFunction":
            self._allow(e.nameParts(), FUNCTIONS, FUNCTION_GROUPS)
        elif kind == "UnresolvedGenerator":
            name = e.name()
            self._allow([*([name.database().get()] if name.database().isDefined() else []), name.funcName()], TABLE_FUNCTIONS, FUNCTION_GROUPS)
        elif kind not in PARSED_EXPRESSIONS:
            self._class(e)
        if _is(self.spark, e, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            self._parsed(e.plan(), known)
        for x in _items(e.children()):
            self._parsed_expression(x, known)

    # the analysed plan

    def _analysed(self, plan) -> None:
        kind = _kind(plan)
        if kind not in NODES:
            raise Refused(f"{kind} isn't allowed")
        if kind == "View":  # temporary, and one of those registered; what it reads isn't the statement's
            if not plan.isTempView() or plan.desc().identifier().table().lower() not in {v.lower() for v in self.views}:
                raise Refused(f"no such table: {plan.desc().identifier().unquotedString()}")
            return
        for e in _items(plan.expressions()):
            self._analysed_expression(e)
        for p in _items(plan.children()):
            self._analysed(p)

    def _analysed_expression(self, e) -> None:
        self._class(e)
        if _is(self.spark, e, "org.apache.spark.sql.catalyst.expressions.PlanExpression"):
            self._analysed(e.plan())
        # some functions hold what replaces them; what they were given is what counts
        held = e.parameters() if _is(self.spark, e, "org.apache.spark.sql.catalyst.expressions.InheritAnalysisRules") else e.children()
        for x in _items(held):
            self._analysed_expression(x)

    def _class(self, e) -> None:
        """Refuse an expression whose class is neither listed nor that of an allowed function."""
        if not self.classes:
            registry = self.spark._jsparkSession.sessionState().functionRegistry()
            found = set()
            for f in _items(registry.listFunction()):
                info = registry.lookupFunction(f)
                if info.isDefined() and (info.get().getGroup() in FUNCTION_GROUPS or f.funcName() in FUNCTIONS or f.funcName() in TABLE_FUNCTIONS) and info.get().getClassName().startswith("org.apache.spark.sql.catalyst.expressions."):
                    found.add(info.get().getClassName().rsplit(".", 1)[1])
            self.classes = frozenset(found) | frozenset(EXPRESSIONS)
        name, kind = e.getClass().getName(), _kind(e)
        if kind not in self.classes or not name.startswith("org.apache.spark.sql.catalyst.expressions."):
            raise Refused(f"{kind} isn't allowed")

    def _allow(self, parts, names: tuple[str, ...], groups) -> None:
        parts = parts if isinstance(parts, list) else _items(parts)
        name = ".".join(parts).lower()
        if name in names:
            return
        if len(parts) == 1:
            state, jvm = self.spark._jsparkSession.sessionState(), self.spark.sparkContext._jvm
            try:
                if state.catalog().lookupFunctionInfo(jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name)).getGroup() in groups:
                    return
            except Exception:  # there is none of that name
                pass
        raise Refused(f"the function {name} isn't allowed")

    def _bounded(self, df: DataFrame, n: int) -> DataFrame:
        """At most n rows, as many as fit into the bytes of a result, and whether others didn't (a row
        of nulls stands for them), so that a wide result is cut off before it reaches the driver."""
        names = [f"c{i}" for i in range(len(df.columns))]
        rows = df.limit(n).toDF(*names).coalesce(1).withColumn("__at", F.monotonically_increasing_id())
        size = F.octet_length(F.struct(*names).cast("string")).cast("long") if names else F.lit(0).cast("long")
        sized = rows.withColumn("__bytes", F.sum(size).over(Window.orderBy("__at")))  # n rows
        kept = F.col("__bytes") <= self.result_bytes
        first = F.col("__bytes") - size <= self.result_bytes  # of those that are cut, at most the first
        cells = [F.when(kept, F.col(c)).alias(c) for c in names]
        return sized.filter(kept | first).orderBy("__at").select(*cells, (~kept).alias("__cut"))

    def query_sql(self, sql: str, max_rows: int = DEFAULT_ROWS) -> dict:
        """Rows as JSON, at most max_rows (1 to 500); an error instead if it is refused, fails or takes too long."""
        n = max(1, min(MOST_ROWS, int(max_rows)))
        tag, late = f"tabloom-{uuid.uuid4().hex}", threading.Event()
        try:
            df = self.check(sql)
        except (Refused, PySparkException, Py4JJavaError) as e:
            return {"error": str(e).splitlines()[0][:500]}

        def stop() -> None:
            late.set()
            self.spark.sparkContext.cancelJobsWithTag(tag)

        timer = threading.Timer(self.timeout_s, stop)
        self.spark.sparkContext.addJobTag(tag)
        timer.start()
        try:
            rows = self._bounded(df, n + 1).collect()
            cut = bool(rows) and rows[-1]["__cut"]
            rows = [r[:-1] for r in rows if not r["__cut"]]
        except Exception as e:
            return {"error": f"stopped after {self.timeout_s:g} s" if late.is_set() else str(e).splitlines()[0][:500]}
        finally:
            timer.cancel()
            self.spark.sparkContext.removeJobTag(tag)
        return {"columns": df.columns, "rows": [[jsonable(v) for v in r] for r in rows[:n]], "row_count": min(n, len(rows)), "truncated": len(rows) > n or cut}


def _kind(x) -> str:
    return x.getClass().getName().rsplit(".", 1)[1]


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _is(spark: SparkSession, x, name: str) -> bool:
    jvm = spark.sparkContext._jvm
    return jvm.java.lang.Class.forName(name, False, jvm.java.lang.Thread.currentThread().getContextClassLoader()).isInstance(x)


def _leaves(plan):
    """The relations that a plan reads, those of subqueries in its expressions too."""
    kids = _items(plan.children())
    if not kids:
        yield plan
    for x in [*kids, *_items(plan.subqueries())]:
        yield from _leaves(x)
