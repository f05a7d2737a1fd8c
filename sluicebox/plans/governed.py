"""Ad-hoc SQL limited to approved tables and columns.

The text is judged twice, and nothing runs before both judgements. On the plan Spark's parser returns, only known nodes,
functions and table names may stand. On the plan Spark's analyzer returns, every attribute is followed by its id to the table
it comes from, so a column outside the allow-list is found behind ``*``, aliases, subqueries, WITH and set operations alike.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

from sluicebox.contracts import SERVING_TABLES

DEFAULT_LIMIT = 100

# What a read-only query may consist of. Anything else is refused, known or not.
QUERY_ROOTS = frozenset(
    "Project Aggregate UnresolvedHaving Sort GlobalLimit LocalLimit LimitAll Offset Distinct Filter "
    "WithWindowDefinition Union Except Intersect UnresolvedWith SubqueryAlias".split()
)
PLAN_NODES = QUERY_ROOTS | frozenset("Join UnresolvedRelation OneRowRelation".split())
EXPRESSION_NODES = frozenset(
    "Add Alias And AttributeReference CaseWhen Cast Concat CreateNamedStruct Cube CurrentRow$ Divide EqualNullSafe EqualTo "
    "Exists GreaterThan GreaterThanOrEqual GroupingSets ILike In InSubquery IntegralDivide IsNotNull IsNull LessThan "
    "LessThanOrEqual Like LikeAll LikeAny ListQuery Literal Multiply Not NotLikeAll NotLikeAny Or Overlay RLike Remainder "
    "Rollup ScalarSubquery SortOrder SpecifiedWindowFrame StringLocate StringTrim StringTrimLeft StringTrimRight Substring "
    "Subtract UnaryMinus UnaryPositive UnboundedFollowing$ UnboundedPreceding$ UnresolvedAlias UnresolvedAttribute "
    "UnresolvedExtractValue UnresolvedFunction UnresolvedOrdinal UnresolvedStar UnresolvedStarExceptOrReplace "
    "UnresolvedWindowExpression UnspecifiedFrame$ WindowExpression WindowSpecDefinition".split()
)
FUNCTIONS = frozenset(
    "abs acos add_months any any_value approx_count_distinct approx_percentile array asin atan atan2 avg between bool_and "
    "bool_or bround cast ceil ceiling char_length character_length coalesce collect_list collect_set concat concat_ws contains "
    "corr cos count count_if covar_pop covar_samp cume_dist current_date current_timestamp date date_add date_diff date_format "
    "date_part date_sub date_trunc dateadd datediff day dayofmonth dayofweek dayofyear dense_rank endswith every exp extract "
    "first first_value floor format_number from_unixtime greatest grouping grouping_id hour if ifnull initcap instr isnan "
    "isnotnull isnull kurtosis lag last last_day last_value lcase lead least left length like ln locate log log10 log2 lower lpad "
    "ltrim make_date max max_by mean median min min_by minute mod mode month months_between named_struct next_day now nth_value "
    "ntile nullif nullifzero nvl nvl2 percent_rank percentile percentile_approx percentile_cont percentile_disc pi pmod position "
    "pow power quarter rank regexp_extract regexp_like regexp_replace repeat replace reverse right rint rlike round row_number "
    "rpad rtrim second sign signum sin size skewness some split sqrt startswith std stddev stddev_pop stddev_samp substr substring "
    "sum tan timestamp to_date to_timestamp translate trim trunc try_add try_divide try_multiply try_subtract try_sum try_avg "
    "ucase unix_timestamp upper var_pop var_samp variance weekday weekofyear when width_bucket year zeroifnull".split()
)
LIMIT_ROOTS = frozenset({"GlobalLimit", "LocalLimit"})
# Nodes that hand on or compare whole rows of what is below without naming the columns.
WHOLE_ROWS = frozenset("Union Intersect Except Distinct CTERelationDef".split())

ColumnLists = Mapping[str, Iterable[str]]


@dataclass(frozen=True)
class Verdict:
    """``limit`` is set where the text has no limit and none can be written behind it."""

    ok: bool
    sql: str
    error: str | None = None
    limit: int | None = None


def _nodes(tree) -> Iterator[dict]:
    """All plan and expression nodes, subqueries and CTE bodies included."""
    if isinstance(tree, dict):
        if "class" in tree:
            yield tree
        for value in tree.values():
            yield from _nodes(value)
    elif isinstance(tree, list):
        for value in tree:
            yield from _nodes(value)


def _kind(node: dict) -> str:
    return node["class"].rsplit(".", 1)[-1]


def _names(text: str) -> list[str]:
    return [part.strip().lower() for part in text.strip("[]").split(",")]


def _root(plan: list[dict]) -> str:
    """The outermost node; a WITH clause lists its body after itself."""
    kinds = [_kind(node) for node in plan]
    return kinds[1] if kinds[0] == "UnresolvedWith" and len(kinds) > 1 else kinds[0]


def _parsed(spark: SparkSession, text: str):
    return spark._jsparkSession.sessionState().sqlParser().parsePlan(text)


def _analyzed(spark: SparkSession, text: str):
    """The resolved plan of a query; commands in it would be skipped, not run."""
    skip = spark._jvm.org.apache.spark.sql.execution.CommandExecutionMode.SKIP()
    return spark._jsparkSession.sessionState().executePlan(_parsed(spark, text), skip).analyzed()


def _limited(spark: SparkSession, text: str, limit: int) -> Verdict:
    """A LIMIT is written behind the text where that parses and limits the whole; else it is applied to the result."""
    longer = f"{text}\nLIMIT {limit}"
    try:
        if _root(json.loads(_parsed(spark, longer).toJSON())) in LIMIT_ROOTS:
            return Verdict(True, longer)
    except ParseException:
        pass
    return Verdict(True, text, limit=limit)


def _each(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _class(node) -> str:
    return node.getClass().getSimpleName()


def source_columns(analyzed) -> dict[str, set[str]]:
    """Per source table, the columns that an analyzed plan reads, in lower case.

    A source is a view or a leaf; what a view is made of is its owner's business. Columns of a source count as read if their
    attribute id is used by any expression above it, is in the result, or belongs to whole rows that are handed on unnamed.
    A source that Spark did not put under its own name has the name ''.
    """
    used: set[int] = set()
    offered: list[tuple[str, dict[int, str]]] = []
    whole = [analyzed]
    stack = [(analyzed, "")]
    while stack:
        node, alias = stack.pop()
        kind = _class(node)
        children = list(_each(node.children()))
        if kind == "View" or not children and kind not in ("CTERelationRef", "OneRowRelation"):
            columns = [*_each(node.output()), *_each(node.metadataOutput())]
            offered.append((alias, {c.exprId().id(): c.name().lower() for c in columns}))
            continue
        used |= {c.exprId().id() for c in _each(node.references().toSeq())}
        if kind in WHOLE_ROWS:
            whole += children
        inner = list(_each(node.subqueries()))
        whole += inner
        below = node.identifier().name().lower() if kind == "SubqueryAlias" else ""
        stack += [(child, below) for child in children] + [(plan, "") for plan in inner]
    for node in whole:
        used |= {c.exprId().id() for c in _each(node.output())}
    read: dict[str, set[str]] = {}
    for table, columns in offered:
        read.setdefault(table, set()).update(name for number, name in columns.items() if number in used)
    return read


def _column_error(analyzed, allowed: ColumnLists | None) -> str | None:
    """What an analyzed plan reads beyond the allow-list: by default the columns of the serving contracts."""
    lists = allowed if allowed is not None else {name: table.columns for name, table in SERVING_TABLES.items()}
    for table, columns in sorted(source_columns(analyzed).items()):
        if table not in lists:
            return f"Table is not approved: {table or 'unnamed source'}."
        outside = sorted(columns - {name.lower() for name in lists[table]})
        if outside:
            return f"Column is not approved: {table}.{outside[0]}."
    return None


def check_sql(
    spark: SparkSession, sql: str, default_limit: int = DEFAULT_LIMIT, allowed: ColumnLists | None = None
) -> Verdict:
    """Accept one read-only query over approved tables and columns; nothing is executed.

    Texts without an outer LIMIT get the default one. A name defined by WITH counts as approved only if no
    table or view of that name exists, so it cannot hide one. ``allowed`` narrows or replaces the contracts' columns.
    Columns are judged where the tables exist; where one does not, no column can be read either.
    """
    verdict = _check_text(spark, sql, default_limit)
    if not verdict.ok:
        return verdict
    try:
        analyzed = _analyzed(spark, verdict.sql)
    except AnalysisException as error:
        missing = error.getCondition() == "TABLE_OR_VIEW_NOT_FOUND"
        return verdict if missing else Verdict(False, verdict.sql, f"SQL cannot be resolved: {error.getCondition()}.")
    error = _column_error(analyzed, allowed)
    return Verdict(False, verdict.sql, error) if error else verdict


def _check_text(spark: SparkSession, sql: str, default_limit: int) -> Verdict:
    """The judgement on the parsed plan."""
    text = sql.strip().rstrip(";").strip()
    if not text:
        return Verdict(False, text, "SQL is empty.")
    try:
        parsed = _parsed(spark, text)
    except ParseException:
        several = ";" in text
        return Verdict(False, text, "Multiple SQL statements are not allowed." if several else "SQL cannot be parsed.")
    plan = json.loads(parsed.toJSON())
    root = _root(plan)
    if root not in QUERY_ROOTS:
        return Verdict(False, text, "Only SELECT queries are allowed.")

    nodes = list(_nodes(plan))
    strange = sorted({_kind(n) for n in nodes} - PLAN_NODES - EXPRESSION_NODES)
    if strange:
        return Verdict(False, text, f"Not allowed in a query: {strange[0]}.")
    called = {".".join(_names(n["nameParts"])) for n in nodes if _kind(n) == "UnresolvedFunction"}
    if called - FUNCTIONS:
        return Verdict(False, text, f"Function is not allowed: {sorted(called - FUNCTIONS)[0]}.")

    defined = {c["_1"].lower() for n in nodes if _kind(n) == "UnresolvedWith" for c in n["cteRelations"]}
    hiding = sorted(name for name in defined if name in SERVING_TABLES or spark.catalog.tableExists(name))
    if hiding:
        return Verdict(False, text, f"WITH name hides a table: {hiding[0]}.")
    used = [_names(n["multipartIdentifier"]) for n in nodes if _kind(n) == "UnresolvedRelation"]
    tables = [parts for parts in used if not (len(parts) == 1 and parts[0] in defined)]
    if not tables:
        return Verdict(False, text, "Query must reference at least one approved table.")
    for parts in tables:
        name = ".".join(parts)
        if parts[-1] not in SERVING_TABLES or (len(parts) > 1 and not spark.catalog.tableExists(name)):
            return Verdict(False, text, f"Table is not approved: {name}.")
    return Verdict(True, text) if root in LIMIT_ROOTS else _limited(spark, text, default_limit)


def run_approved(
    spark: SparkSession,
    sql: str,
    gold: Mapping[str, DataFrame] | None = None,
    default_limit: int = DEFAULT_LIMIT,
    allowed: ColumnLists | None = None,
) -> DataFrame:
    """Run an accepted query; ``gold`` frames are registered as views under their approved names first.

    Columns are judged once more on the very plan that will run, in case a view was replaced meanwhile.
    """
    for name, df in (gold or {}).items():
        if name not in SERVING_TABLES:
            raise ValueError(f"Not an approved table: {name}")
        df.createOrReplaceTempView(name)
    verdict = check_sql(spark, sql, default_limit, allowed)
    if not verdict.ok:
        raise ValueError(verdict.error)
    df = spark.sql(verdict.sql)
    error = _column_error(df._jdf.queryExecution().analyzed(), allowed)
    if error:
        raise ValueError(error)
    return df if verdict.limit is None else df.limit(verdict.limit)
