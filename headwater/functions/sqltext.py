"""Table references in SQL text, from a text column.

The text is cut into tokens, which one loop, over Arrow batches in the tasks, reads with a stack of scopes, one for each open parenthesis, however
deep. A scope knows whether it is in a list of tables, so that a comma after a join condition goes on with the
list, and a comma of the select list doesn't. It knows its common table expressions: they hide tables in their own
statement and below, after their bodies, or inside them if they are recursive. Comments, literals, texts between dollar
signs, quoted names, table functions, ``is distinct from`` and the ``from`` inside functions such as ``extract`` are
known too. Tables of outer statements come first. Targets of INSERT and MERGE are not read, so they are not listed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions.scalars import let

_WORD = r"[\p{L}\p{N}_$]+"
_ATOM = rf"(?:\"[^\"]+\"|`[^`]+`|\[[^\]]+\]|{_WORD})"
IDENTIFIER = rf"{_ATOM}(?:\s*\.\s*{_ATOM})*"
# Comments and literals go; quoted names stay, with whatever they contain.
NOISE = r"(\"[^\"]*\"|`[^`]*`)|'[^']*'|--[^\n]*|/\*[\s\S]*?\*/"
# A FROM that names no table: inside a function, or of a comparison.
OTHER_FROM = r"(?i)\b(?:extract|trim|substring|overlay)\s*\([^()]*\)|\bis\s+(?:not\s+)?distinct\s+from\b"
# After FROM or JOIN: "a", "a x, b y, c"; a "(" behind a name marks a function.
REFERENCES = rf"(?i)\b(?:from|join)\s+((?:{IDENTIFIER}(?:\s+(?:as\s+)?{_WORD})?\s*,\s*)*{IDENTIFIER}(?:\s*\()?)"
FIRST_NAME = rf"^\s*({IDENTIFIER}(?:\s*\()?)"
CTE_NAME = rf"(?i)(?:\bwith\s+(?:recursive\s+)?|,\s*)({_ATOM})\s*(?:\([^()]*\)\s*)?as\s*(?:(?:not\s+)?materialized\s*)?\("
PLAIN_TABLE = rf"^\s*{IDENTIFIER}\s*$"


def _tight(name: Column) -> Column:
    """``a . b`` as ``a.b``."""
    return F.when(name.contains("."), F.regexp_replace(name, r"\s*\.\s*", ".")).otherwise(name)


def _strip_quotes(name: Column) -> Column:
    return F.translate(_tight(name), "\"`[]", "")


def _clean(sql: Column) -> Column:
    """The text without comments, literals and the FROMs that name no table."""
    noisy = sql.contains("'") | sql.contains("--") | sql.contains("/*")
    quiet = F.when(noisy, F.regexp_replace(sql, NOISE, "$1 ")).otherwise(sql)
    return F.regexp_replace(quiet, OTHER_FROM, " ")


def _references(text: Column) -> Column:
    items = F.split(F.array_join(F.regexp_extract_all(text, F.lit(REFERENCES), F.lit(1)), ","), ",")
    names = F.transform(items, lambda item: F.regexp_extract(item, FIRST_NAME, 1))
    tables = F.filter(names, lambda name: (name != "") & ~name.endswith("("))

    def without(ctes: Column) -> Column:
        return F.filter(tables, lambda name: ~F.array_contains(ctes, F.lower(name)))

    ctes = F.transform(F.regexp_extract_all(text, F.lit(CTE_NAME), F.lit(1)), lambda name: F.lower(name))
    found = F.when(text.rlike(r"(?i)^\s*with\b"), let(ctes, without)).otherwise(tables)
    return F.array_distinct(F.transform(found, _tight))


# The same for ``re``, and so with blanks and words as above: comments, literals and texts between dollar signs; names with
# their dots; single marks.
_BLANK = r"[ \t\n\x0b\f\r]"
_ATOM_HERE = r"(?:\"[^\"]+\"|`[^`]+`|\[[^\]]+\]|[\w$]+)"
_TOKEN = re.compile(
    r"--[^\n]*|/\*[\s\S]*?\*/|'[^']*'|\$([A-Za-z0-9_]*)\$[\s\S]*?\$\1\$"
    rf"|{_ATOM_HERE}(?:{_BLANK}*\.{_BLANK}*{_ATOM_HERE})*|[^{_BLANK[1:]}"
)
_SILENT = re.compile(r"--|/\*|'[\s\S]*'$|\$[A-Za-z0-9_]*\$")
_NAMED = re.compile(r"[\w$]|[\"`\[][^\n\r\x85\u2028\u2029]{2}")
# Where none of these is in a text, its tokens are words with their dots and single marks.
_QUOTED = re.compile(r"[\"'`\[$]|--|/\*")
_PLAIN_TOKEN = re.compile(rf"\w+(?:{_BLANK}*\.{_BLANK}*\w+)*|[^{_BLANK[1:]}")
_DOT = re.compile(rf"{_BLANK}*\.{_BLANK}*")
_NO_PLAIN_NAME = re.compile(r"[.\"`\[]")
_QUOTES = str.maketrans("", "", "\"`[]")

# Kinds of tokens. Words that are none of these are names.
_KINDS = ["name", "(", ")", ",", ";", "from", "join", "select", "with", "recursive", "as", "end", "skip", "no name", "using", "delete", "distinct"]
_NAME, _OPEN, _CLOSE, _COMMA, _SEMICOLON, _FROM, _JOIN, _SELECT, _WITH, _RECURSIVE, _AS, _END, _SKIP, _OTHER, _USING, _DELETE, _DISTINCT = range(17)
_WORDS = {
    **{word: kind for kind, word in enumerate(_KINDS) if kind not in (_NAME, _END, _SKIP, _OTHER)},
    **dict.fromkeys(["values"], _SELECT),
    **dict.fromkeys(["merge"], _DELETE),
    **dict.fromkeys(["lateral", "only"], _SKIP),
    # what ends a list of tables
    **dict.fromkeys("where group order having limit union intersect except window qualify returning fetch offset set when".split(), _END),
    **dict.fromkeys("on left right inner outer full cross natural into".split(), _OTHER),
    # stands between the name of a common table expression and its body
    **dict.fromkeys(["materialized"], _AS),
}
# How far a scope's list of common table expressions is.
_NO_LIST, _WANTS_NAME, _WANTS_BODY, _HAS_BODY = range(4)


def _word(token: str) -> tuple[int, str]:
    kind = _WORDS.get(token.lower(), _NAME)
    if kind == _NAME and "." in token:
        token = _DOT.sub(".", token).translate(_QUOTES)
    return kind, token


def _plain_tokens(sql: str) -> list[tuple[int, str]]:
    """The same as :func:`_tokens` for a text without quotes, comments and dollar signs, in one pass of a simpler pattern."""
    tokens, words = _PLAIN_TOKEN.findall(sql), _WORDS
    return [
        (kind, token) if (kind := words.get(token.lower())) is not None
        else (_NAME, token) if (first := token[0]).isalnum() and "." not in token or first == "_" and "." not in token
        else _word(token) if first.isalnum() or first == "_"
        else (_OTHER, token)
        for token in tokens
    ]


def _tokens(sql: str) -> Iterator[tuple[int, str]]:
    """The kinds of the tokens of a text and their names, without comments and literals."""
    for match in _TOKEN.finditer(sql):
        token = match[0]
        first = token[0]
        # most tokens are words or single marks, which need no further pattern
        if first.isalnum() or first == "_":
            yield _word(token)
            continue
        if len(token) == 1 and first != "$":
            yield _WORDS.get(token, _OTHER), token
            continue
        if first in "-/'$" and _SILENT.match(token):
            continue
        kind = _WORDS.get(token.lower())
        if kind is None:
            kind = _NAME if _NAMED.match(token) else _OTHER
        if kind == _NAME and _NO_PLAIN_NAME.search(token):
            token = _DOT.sub(".", token).translate(_QUOTES)
        yield kind, token


def _tables_of(sql: str) -> list[str]:
    """The distinct names of the tables that a text reads, those of outer statements first."""
    # what is known of the scope: whether a FROM counts in it, whether it is in a list of tables, whether USING
    # names a table in it, and its common table expressions
    counts, in_list, uses, ctes_at, recursive, cte = True, False, False, _NO_LIST, False, None
    wants, last, pending = False, _NAME, None
    stack: list[tuple] = []
    ctes: list[tuple[int, str]] = []
    found: list[tuple[int, str]] = []

    def add() -> None:
        """The name that waits for the token after it is a table, unless it is a common table expression."""
        if not any(name == pending.lower() for _, name in ctes):
            found.append((len(stack), pending))

    for kind, name in _tokens(sql) if _QUOTED.search(sql) else _plain_tokens(sql):
        # a name before the parenthesis is a function's; tables or a statement stand where a table is wanted
        if pending is not None and kind != _OPEN:
            add()
        if kind in (_NAME, _OTHER) and ctes_at != _WANTS_NAME:
            pending, wants, last = name if wants and kind == _NAME else None, False, kind
            continue
        depth = len(stack)
        from_counts = kind == _FROM and counts and last != _DISTINCT
        with_starts = kind == _WITH and (wants or not in_list)
        starts = kind in (_SELECT, _DELETE, _SEMICOLON)
        names_table = from_counts or (kind == _USING and uses) or kind == _JOIN
        wanted, listed, waiting = wants, in_list, pending
        wants = names_table or (kind == _COMMA and in_list) or (kind == _SKIP and wants)
        pending = name if kind == _NAME and wanted else None
        if kind == _OPEN:
            body = _HAS_BODY if ctes_at == _WANTS_BODY and last == _AS else ctes_at
            stack.append((counts, in_list, uses, body, recursive, cte))
            wants = counts = in_list = wanted and waiting is None and last != _USING
            uses, ctes_at, recursive, cte = False, _NO_LIST, False, None
        elif kind == _CLOSE and depth:
            # a common table expression is known after its body, or from its name on if it is recursive
            ctes = [known for known in ctes if known[0] < depth]
            counts, in_list, uses, ctes_at, recursive, cte = stack.pop()
            if ctes_at == _HAS_BODY and cte is not None:
                ctes.append((depth - 1, cte))
        else:
            if kind == _SEMICOLON:
                ctes = [known for known in ctes if known[0] < depth]
            counts = counts or starts or with_starts
            in_list = names_table or (listed and not (starts or with_starts or kind == _END))
            uses = kind == _DELETE or (uses and kind not in (_USING, _SELECT, _SEMICOLON))
            if kind == _NAME and ctes_at == _WANTS_NAME:
                ctes_at, cte = _WANTS_BODY, name.lower()
                if recursive:
                    ctes.append((depth, cte))
            elif with_starts:
                ctes_at = _WANTS_NAME
            elif kind == _COMMA and ctes_at == _HAS_BODY:
                ctes_at = _WANTS_NAME
            elif starts or kind == _END:
                ctes_at = _NO_LIST
            recursive = kind == _RECURSIVE or (recursive and not with_starts)
        last = kind
    if pending is not None:
        add()
    # outer statements first, and else as they stand
    return list(dict.fromkeys(name for _, name in sorted(found, key=lambda place: place[0])))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _tables_of_texts(texts: pa.Array) -> pa.Array:
    """The tables of each text of a batch. NULL texts have none, and cost no loop."""
    given = texts.is_valid()
    found = pa.array([_tables_of(sql) for sql in texts.drop_null().to_pylist()], pa.list_(pa.string()))
    if not texts.null_count:
        return found
    place = np.cumsum(given.to_numpy(zero_copy_only=False)) - 1
    return found.take(pa.array(place, mask=~given.to_numpy(zero_copy_only=False)))


def sql_tables(sql: Column, compat: bool = False) -> Column:
    """Distinct names of the tables that a text reads: after FROM and JOIN, and after the USING of DELETE and MERGE.

    ``compat`` looks for patterns in the text as a whole; it keeps quotes around
    names, and gives nothing for a text whose parentheses do not pair up, as a
    grammar would.
    """
    if not compat:
        return _tables_of_texts(sql)

    def tables(text: Column) -> Column:
        opened, closed = (F.length(F.translate(text, mark, "")) for mark in "()")
        return F.when(opened == closed, _references(text)).otherwise(F.array().cast("array<string>"))

    return let(_clean(sql), tables)


def _unwrapped(query: Column) -> Column:
    """What stands between the first parenthesis and the last, if the text begins with one and none is open behind the last."""
    text = F.ltrim(query, F.lit(" \t\n\x0b\f\r"))
    rest = F.substring_index(text, ")", -1)
    wrapped = text.startswith("(") & text.contains(")") & ~rest.contains("(")
    inner = F.substr(text, F.lit(2), F.length(text) - F.length(rest) - F.lit(2))
    return F.when(wrapped, inner).otherwise(query)


def jdbc_tables(table_or_query: Column, compat: bool = False) -> Column:
    """Tables of a JDBC ``dbtable`` value: a table, ``(query) alias``, or a query.

    ``compat`` reads only what lies between the first ``(`` and the first ``)``,
    so that a plain table, or a query with its own parentheses, gives nothing.
    """
    none = F.array().cast("array<string>")
    if compat:
        inner = F.regexp_extract(table_or_query, r"^[^()]*\(([^)]*)\)", 1)
        is_query = inner.rlike(r"(?i)^\s*(select|with)\b")
        return F.coalesce(F.when(is_query, sql_tables(inner, compat=True)), none)
    return _jdbc_or_sql(table_or_query, F.lit(True))


def _jdbc_or_sql(source: Column, is_jdbc: Column) -> Column:
    """Tables of JDBC values, and of plain queries where a source isn't one: all of them go through one reader."""
    is_table = is_jdbc & source.rlike(PLAIN_TABLE)
    query = F.when(~is_jdbc, source).when(~is_table, _unwrapped(source))
    found = F.when(is_table, F.array(_strip_quotes(F.trim(source)))).otherwise(sql_tables(query))
    return F.coalesce(found, F.when(is_jdbc, F.array().cast("array<string>")))


def source_tables(source: Column, is_jdbc: Column, compat: bool = False) -> Column:
    """:func:`jdbc_tables` where a source is one of JDBC, :func:`sql_tables` of the others; NULL for those without a text."""
    if not compat:
        return _jdbc_or_sql(source, F.coalesce(is_jdbc, F.lit(False)))
    return F.when(is_jdbc, jdbc_tables(source, compat)).when(source.isNotNull(), sql_tables(source, compat))
