"""Fields out of JSON payloads, parsed once per row on the JVM side.

Numbers keep the digits they are written with.  A parser would make doubles and decimals of them, so before
parsing every number token becomes a string with a mark in front, and the mark goes when text comes
out.  Strings that begin with the mark's character get another mark.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.functions.urls import as_column

# Tokens cover the text without gaps: strings, other words, punctuation, white space.
TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\s",:\[\]{}]++|\s++|.'
# How a value begins, and all of it unless it is an object or array.
VALUE = r'(?s)^\s*(?:[\[{]|(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^\s",:\[\]{}]++)\s*$)'
NUMBER = r"^-?(?:0|[1-9][0-9]*)(?:[.][0-9]+)?(?:[eE][+-]?[0-9]+)?$"

_ELEMENT = re.compile(r'\s*(?:"((?:[^"\\]|\\.)*)"|([^,"]*))\s*(?:,|$)')


def path_elements(path: str) -> list[str]:
    """``{a,b,0}`` to its elements; double quotes protect commas."""
    inner = path.strip()
    if not (inner.startswith("{") and inner.endswith("}")):
        raise ValueError(f"a path looks like {{a,b,0}}, got {path!r}")
    inner = inner[1:-1]
    if not inner.strip():
        return []
    out, at = [], 0
    while at <= len(inner):
        m = _ELEMENT.match(inner, at)
        if not m:
            raise ValueError(f"cannot read path {path!r}")
        quoted, bare = m.groups()
        out.append(re.sub(r"\\(.)", r"\1", quoted) if quoted is not None else bare.strip())
        if m.end() == len(inner) and not m.group(0).endswith(","):
            return out
        at = m.end()
    return out


def _key(element: str) -> str:
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", element):
        return f".{element}"
    if "'" in element:
        if '"' in element:
            raise ValueError(f"a key with both kinds of quotes is not supported: {element!r}")
        return f'["{element}"]'
    return f"['{element}']"


def json_paths(elements: list[str]) -> list[str]:
    """JSON paths of a list of path elements.

    A whole number names an array element or an object key, depending on the
    value it meets, so it yields one path for each reading.
    """
    choices = [
        [f"[{int(e)}]", _key(e)] if e.isascii() and e.isdigit() else [_key(e)] for e in elements
    ]
    return ["$" + "".join(steps) for steps in itertools.product(*choices)]


def _marked(text: Column) -> Column:
    """The payload as the one element of an array, with marked numbers; what no value can be is left empty."""

    def mark(token: Column) -> Column:
        rest = F.substring(token, F.lit(8), F.length(token))
        return (
            F.when(token.rlike(NUMBER), F.concat(F.lit('"\\u0001n'), token, F.lit('"')))
            .when(token.startswith('"\\u0001'), F.concat(F.lit('"\\u0001s'), rest))
            .otherwise(token)
        )

    tokens = F.regexp_extract_all(text, F.lit(f"(?s){TOKENS}"), F.lit(0))
    value = F.concat(F.lit("["), F.array_join(F.transform(tokens, mark), ""), F.lit("]"))
    return F.when(text.rlike(VALUE), value).when(text.isNotNull(), F.lit(""))


def _plain(text: Column, variant: Column) -> Column:
    """Marks taken out of the text of a variant."""
    rest = F.substring(text, F.lit(3), F.length(text))
    inner = F.regexp_replace(text, r'"\\u0001n([^"]*+)"', "$1")
    scalar = ~text.rlike(r"^[\[{]") | F.to_json(variant).startswith('"')
    return (
        F.when(text.startswith("\x01n"), rest)
        .when(text.startswith("\x01s"), F.concat(F.lit("\x01"), rest))
        .when(scalar, text)
        .otherwise(F.replace(inner, F.lit('"\\u0001s'), F.lit('"\\u0001')))
    )


def _get(variant: Column, elements: list[str], kind: str) -> Column:
    return F.coalesce(*[F.try_variant_get(variant, p, kind) for p in json_paths(elements)])


def json_text(variant: Column, path: str) -> Column:
    """Value at ``path`` of a parsed payload as text; NULL when missing, JSON null or not reachable.

    ``-1`` names the last element of an array, ``-2`` the one before.
    """
    return _plain(*_located(variant, path))


def _located(variant: Column, path: str) -> tuple[Column, Column]:
    """The value at ``path`` as marked text and as a variant."""
    elements = path_elements(path)
    for i, element in enumerate(elements):
        if re.fullmatch(r"-[1-9][0-9]*", element):
            array = _get(variant, elements[:i], "array<variant>")
            from_end = F.try_element_at(array, F.lit(int(element)))
            variant = F.coalesce(from_end, _get(variant, elements[: i + 1], "variant"))
            rest = "{" + ",".join(_quoted(e) for e in elements[i + 1 :]) + "}"
            return _located(variant, rest)
    return _get(variant, elements, "string"), _get(variant, elements, "variant")


def _quoted(element: str) -> str:
    return '"' + re.sub(r'(["\\])', r"\\\1", element) + '"'


def parse_payload(col: Column | str, lenient: bool = False) -> Column:
    """A payload ready for ``json_text``: a variant with marked numbers.

    Strict parsing raises on malformed JSON, text after the value included; lenient parsing gives NULL.
    Of duplicate keys the last counts: a setting of the session, which is switched on here and left
    on, since Spark reads it anew whenever a view or a join is analysed.
    """
    _last_key_wins(SparkSession.active())
    parsed = (F.try_parse_json if lenient else F.parse_json)(_marked(as_column(col)))
    return F.try_variant_get(parsed, "$[0]", "variant")


def _last_key_wins(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def json_fields(
    df: DataFrame, col: str, fields: dict[str, str], lenient: bool = False
) -> DataFrame:
    """Add one text column per ``{name: path}``.  Of duplicate keys the last counts."""
    parsed = df.withColumn("__json", parse_payload(col, lenient))
    found = [_located(F.col("__json"), path) for path in fields.values()]
    # Texts get columns of their own first, or they would be looked up once for each test of a mark.
    texts = parsed.select("*", *[text.alias(f"__text{i}") for i, (text, _) in enumerate(found)])
    plain = [_plain(F.col(f"__text{i}"), value).alias(n) for i, (n, (_, value)) in enumerate(zip(fields, found))]
    return texts.select(*df.columns, *plain)
