"""Predicates that are data: plain comparisons as arrays of parts that meet the rows in a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"-?[0-9]{1,18}(?:[.][0-9]{1,9})?"
_TEXT = r"'[^'\\]*'"
_VALUE = rf"(?:{_NUMBER}|{_TEXT})"
#: What follows holds an even number of quotes, so the place is outside a text.
_OUTSIDE = r"(?=(?:[^']*'[^']*')*[^']*$)"
_COMPARED = rf"^([A-Za-z_][A-Za-z0-9_]*)\s*(<=|>=|<>|!=|==|=|<|>)\s*({_VALUE})$"
_LISTED = rf"(?i)^([a-z_][a-z0-9_]*)\s+in\s*[(]\s*({_VALUE}(?:\s*,\s*{_VALUE})*)\s*[)]$"
_NULL = r"(?i)^([a-z_][a-z0-9_]*)\s+is\s+(not\s+)?null$"
_BETWEEN = rf"(?i)\b([a-z_][a-z0-9_]*)\s+between\s+({_VALUE})\s+and\s+({_VALUE}){_OUTSIDE}"

_EXACT = T.DecimalType(38, 9)
_PART = "struct<kind:string,at:int,op:string,exact:array<decimal(38,9)>,real:array<double>,text:array<string>>"


def _kind(type_: T.DataType) -> str:
    """How values of a column are compared with a stored one: exactly, as doubles, as texts, or not at all."""
    if isinstance(type_, T.DecimalType):
        return "exact" if type_.scale <= _EXACT.scale and type_.precision - type_.scale <= _EXACT.precision - _EXACT.scale else "other"
    if isinstance(type_, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "exact"
    if isinstance(type_, T.DoubleType):
        return "real"
    return "text" if type_ == T.StringType() else "other"


class Predicates:
    """Stored predicates over the columns of ``rows`` as arrays.

    ``parsed`` turns a text into its alternatives (OR), each an array of parts
    (AND): a column compared with a number or text, an IN list, BETWEEN or a
    null test, without parentheses. Any other text, one that names a column the
    rows have not got, and one whose value is not of the column's kind give null.
    ``holds`` evaluates them with SQL's meaning: null is not true.
    """

    def __init__(self, rows: DataFrame):
        exact_names = rows.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        self._fold = (lambda c: c) if exact_names else F.lower
        names = [f.name if exact_names else f.name.lower() for f in rows.schema.fields]
        self._fields = [(n, f.name, _kind(f.dataType)) for n, f in zip(names, rows.schema.fields, strict=True) if names.count(n) == 1]

    def parsed(self, text: Column) -> Column:
        plain = F.regexp_replace(F.trim(text), _BETWEEN, "$1 >= $2 and $1 <= $3")
        split = lambda c, word: F.split(c, rf"(?i)\s+{word}\s+{_OUTSIDE}")
        known = F.create_map(*[F.lit(x) for at, (name, _, kind) in enumerate(self._fields) for x in (name, f"{kind}:{at}")])

        def parts(some: Column) -> Column:
            # one step at a time: a lambda's variable is evaluated once, however often it is used
            cut = F.transform(split(some, "and"), lambda p: self._cut(F.trim(p)))
            bound = F.transform(cut, lambda c: F.struct(c["op"].alias("op"), c["values"].alias("values"), F.split(F.try_element_at(known, c["name"]), ":").alias("place")))
            return F.transform(bound, lambda b: self._part(b["op"], b["values"], b["place"][0], b["place"][1].cast("int")))

        # an array of one, so that the test of the parts reads what is made once
        found = F.array(F.transform(split(plain, "or"), parts))
        return F.get(F.filter(found, lambda x: F.forall(x, lambda some: F.forall(some, lambda p: p.isNotNull()))), F.lit(0))

    def _cut(self, part: Column) -> Column:
        """name, op and values of a part; no name if it is none."""
        at = lambda pattern, group: F.regexp_extract(part, pattern, group)
        compared, listed, null = (F.regexp_like(part, F.lit(p)) for p in (_COMPARED, _LISTED, _NULL))
        values = lambda body: F.regexp_extract_all(body, F.lit(f"({_VALUE})"), 1)
        made = lambda name, op, found: F.struct(self._fold(name).alias("name"), op.alias("op"), found.alias("values"))
        empty = F.array().cast("array<string>")
        return (
            F.when(compared, made(at(_COMPARED, 1), at(_COMPARED, 2), values(at(_COMPARED, 3))))
            .when(listed, made(at(_LISTED, 1), F.lit("in"), values(at(_LISTED, 2))))
            .when(null, made(at(_NULL, 1), F.when(at(_NULL, 2) == "", "null").otherwise("present"), empty))
        )

    @staticmethod
    def _part(op: Column, values: Column, kind: Column, at: Column) -> Column:
        """The part as stored; null if it is none or its values are not of the column's kind."""
        quoted = lambda v: F.substring(v, 1, 1) == "'"
        fits = F.when(kind == "text", F.forall(values, quoted)).when(kind.isin("exact", "real"), ~F.exists(values, quoted)).otherwise(False)
        usable = kind.isNotNull() & (op.isin("null", "present") | fits)
        made = F.struct(
            kind.alias("kind"), at.alias("at"), op.alias("op"),
            F.when(kind == "exact", values.cast("array<decimal(38,9)>")).alias("exact"),
            F.when(kind == "real", values.cast("array<double>")).alias("real"),
            F.when(kind == "text", F.transform(values, lambda v: F.substring(v, F.lit(2), F.length(v) - 2))).alias("text"),
        )
        return F.when(usable, made.cast(_PART))

    def holds(self, alternatives: Column) -> Column:
        """Whether any alternative is all true for the row."""
        typed = {"exact": _EXACT, "real": T.DoubleType(), "text": T.StringType()}
        column = lambda name: F.col(f"`{name.replace('`', '``')}`")
        values = {k: F.array(*[column(c).cast(t) if kind == k else F.lit(None).cast(t) for _, c, kind in self._fields]) for k, t in typed.items()}
        missing = F.array(*[column(c).isNull() for _, c, _ in self._fields])

        def true(p: Column, own: Column) -> Column:
            verdict = F.when(p["op"] == "null", own["missing"]).when(p["op"] == "present", ~own["missing"])
            for k in typed:
                value, stored = own[k], F.get(p[k], F.lit(0))
                result = F.when(p["op"].isin("=", "=="), value == stored).when(p["op"].isin("<>", "!="), value != stored)
                result = result.when(p["op"] == "<", value < stored).when(p["op"] == "<=", value <= stored)
                result = result.when(p["op"] == ">", value > stored).when(p["op"] == ">=", value >= stored)
                verdict = verdict.when(p["kind"] == k, result.otherwise(F.array_contains(p[k], value)))
            return F.coalesce(verdict, F.lit(False))

        def part(p: Column) -> Column:
            own = F.struct(*[F.get(v, p["at"]).alias(k) for k, v in values.items()], F.get(missing, p["at"]).alias("missing"))
            return F.exists(F.array(own), lambda o: true(p, o))

        return F.exists(alternatives, lambda some: F.forall(some, part))
