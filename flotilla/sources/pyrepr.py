"""Flat Python dict reprs as columns: written, cut into records, and parsed.

A line of text is cut into records at braces that stand outside strings; a
record is cut into tokens (strings in either quote style, punctuation, bare
words), whose places say what they are: in a flat record of n entries there are
4n + 1 tokens, and from the first on they repeat as key, colon, value, comma.
A string is decoded from its runs and escapes in order. All of it is array
functions over regular expressions without backtracking, so a value of any
length is read, and nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

_STRING = r"""'(?:[^'\\]++|\\.)*+'|"(?:[^"\\]++|\\.)*+\""""
_NESTED = r"\{[^{}]*+\}"
for _ in range(4):  # braces within braces: such a record is one piece, to be rejected whole
    _NESTED = rf"""\{{(?:[^{{}}'"]++|{_STRING}|{_NESTED})*+\}}"""
#: A record, an opening brace that none closes with all that follows it, or what lies between records.
_PIECE = rf"({_NESTED}|\{{.*+|[^{{]++)"
_TOKEN = rf"""({_STRING}|[{{}}:,]|[^\s{{}}:,'"]++|['"])"""
#: What may stand between records (a list of them, too).
_BETWEEN = r"[\s,\[\]]*+"
_ESCAPE = r"([^\\]++|\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\.|\\)"
#: The escapes of one letter.
_SHORT = {"\\n": "\n", "\\r": "\r", "\\t": "\t", "\\'": "'", '\\"': '"', "\\\\": "\\", "\\a": "\a", "\\b": "\b", "\\f": "\f", "\\v": "\v", "\\0": "\0"}


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s){pattern}"), F.lit(1))


def pieces(line: Column) -> Column:
    """The records of a line, and whatever else stands in it but separators."""
    return F.filter(_all(line, _PIECE), lambda p: ~p.rlike(f"(?s)^{_BETWEEN}$"))


def _char_of(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def _unescaped(run: Column) -> Column:
    """One run or escape of a string."""
    point = F.decode(F.unhex(F.lpad(F.substring(run, 3, 8), 8, "0")), "UTF-32")
    return (F.when(~run.startswith("\\"), run).when(run.rlike(r"^\\[xuU]."), point)
            .otherwise(F.coalesce(_char_of(_SHORT, run), run)))


def text_of(token: Column) -> Column:
    """The text of a quoted token."""
    inner = F.substring(token, F.lit(2), F.char_length(token) - 2)
    decoded = F.array_join(F.transform(_all(inner, _ESCAPE), _unescaped), "")
    return F.when(F.instr(token, "\\") == 0, inner).otherwise(decoded)


def _quoted(token: Column) -> Column:
    return token.rlike("""(?s)^(?:'.*+(?<=')|".*+(?<="))$""") & (F.char_length(token) >= 2)


def _value(token: Column, kind: T.DataType) -> tuple[Column, Column]:
    """(value, it is one of this type) of a value token."""
    none = token == "None"
    if isinstance(kind, T.BooleanType):
        value = F.when(token == "True", F.lit(True)).when(token == "False", F.lit(False))
    elif isinstance(kind, T.StringType):
        value = F.when(_quoted(token), text_of(token)).when(~none & token.rlike("^[A-Za-z0-9_.+-]+$"), token)
    elif isinstance(kind, (T.IntegralType, T.FractionalType)):
        value = F.when(token.rlike("^[-+]?(?:[0-9.][0-9.eE+-]*|inf|nan)$"), token).try_cast(kind)
    else:
        value = F.when(_quoted(token), text_of(token)).try_cast(kind)
    return F.when(~none, value), none | value.isNotNull()


def parse(records: DataFrame, raw: str, schema: T.StructType, row: str, whole: str) -> DataFrame:
    """``records`` with ``row``, a struct of ``schema``, and ``whole``, from the text of a record in
    column ``raw``. A key the record lacks is NULL, a key the schema lacks is passed
    over; a value of another type, a nested value or a broken record isn't whole."""
    n = F.size("_tokens")

    def at(place: int) -> Column:
        return F.filter("_tokens", lambda _, i: (i % 4 == place) & (i > 0) & (i < n - 1))

    def token(name: str) -> Column:
        return F.get("_values", (F.array_position("_keys", F.lit(name)) - 1).cast("int"))

    # A select a step: each is computed once, and the next refers to it.
    steps = records.withColumn("_tokens", _all(F.col(raw), _TOKEN))
    steps = steps.withColumns({"_keys": F.transform(at(1), text_of), "_values": at(3), "_flat": (
        (F.get("_tokens", F.lit(0)) == "{") & (F.get("_tokens", n - 1) == "}") & ((n == 2) | (n % 4 == 1))
        & F.forall(at(0), lambda t: t == ",") & F.forall(at(1), _quoted) & F.forall(at(2), lambda t: t == ":")
        & F.forall(at(3), lambda t: ~t.rlike("""(?s)^(?:[{}:,]|['"])$""")))})
    places = [f"_token{i}" for i in range(len(schema.fields))]
    # Position 0 (the key is missing) asks for entry -1, which is none.
    steps = steps.select(*records.columns, "_flat", *[token(f.name).alias(p) for p, f in zip(places, schema.fields)])
    typed = [_value(F.col(p), f.dataType) for p, f in zip(places, schema.fields)]
    steps = steps.select(*records.columns, "_flat", *[F.struct(v.cast(f.dataType).alias("v"), (F.col(p).isNull() | F.coalesce(ok, F.lit(False))).alias("ok")).alias(p)
                                                      for p, f, (v, ok) in zip(places, schema.fields, typed)])
    fine = F.coalesce(F.col("_flat"), F.lit(False))
    for p in places:
        fine = fine & F.col(p)["ok"]
    return steps.select(*records.columns, F.struct(*[F.col(p)["v"].alias(f.name) for p, f in zip(places, schema.fields)]).alias(row), fine.alias(whole))


#: How a repr shows control characters and the backslash.
_SHOWN = {chr(c): f"\\x{c:02x}" for c in (*range(0x20), 0x7F)} | {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\\": "\\\\"}


def literal(value: Column, kind: T.DataType) -> Column:
    """A value as Python's repr shows it: strings in single quotes, or in double
    ones where they hold a single quote and no double one; line ends, tabs and other
    control characters as escapes."""
    if isinstance(kind, T.BooleanType):
        shown = F.when(value, F.lit("True")).when(~value, F.lit("False"))
    elif isinstance(kind, T.StringType):
        plain = F.concat(F.lit("'"), value, F.lit("'"))
        quote = F.when(F.contains(value, F.lit('"')) | ~F.contains(value, F.lit("'")), F.lit("'")).otherwise(F.lit('"'))
        runs = _all(value, r"([^\x00-\x1f\x7f\\']++|.)")
        inner = F.array_join(F.transform(runs, lambda r: F.when((r == "'") & F.contains(value, F.lit('"')), F.lit("\\'")).otherwise(F.coalesce(_char_of(_SHOWN, r), r))), "")
        shown = F.when(~value.rlike(r"[\x00-\x1f\x7f\\']"), plain).otherwise(F.concat(quote, inner, quote))
    elif isinstance(kind, T.FractionalType):
        shown = F.when(F.isnan(value.cast("double")), F.lit("nan")).otherwise(F.replace(value.cast("string"), F.lit("Infinity"), F.lit("inf")))
    else:
        shown = value.cast("string")
    return F.coalesce(shown, F.lit("None"))
