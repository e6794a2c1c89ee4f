"""URL predicates as column expressions.

The pattern is written for the JVM regex engine: label repetition is
possessive, so matching is iterative.  A plain ``(label\\.)*`` group recurses
once per label and a hostile host name overflows the executor's stack.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: URL grammar, after a URL validation pattern that is --------
# Copyright (c) 2010-2013 Diego Perini, MIT license
SPACE = r" \t\n\x0B\f\r"
HOST_CHAR = r"[a-zA-Z0-9\x{a1}-\x{ffff}]"
HOST_OR_HYPHEN = r"[a-zA-Z0-9\x{a1}-\x{ffff}-]"
TLD_CHAR = r"[a-zA-Z\x{a1}-\x{ffff}]"
SCHEME = r"(?:[hH][tT][tT][pP][sS]?|[fF][tT][pP])"
PORT = r"(?::[0-9]{2,5})?"
BYTE = r"(?:1?[0-9]{1,2}|2[0-4][0-9]|25[0-5])"
FIRST_BYTE = r"(?:[1-9][0-9]?|1[0-9]{2}|2[01][0-9]|22[0-3])"
LAST_BYTE = r"(?:[1-9][0-9]?|1[0-9]{2}|2[0-4][0-9]|25[0-4])"
PRIVATE_NET = (
    r"(?:10|127|169\.254|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))\."
)
# ------------------------------------------------------------------------------

LABEL = f"{HOST_CHAR}(?:{HOST_OR_HYPHEN}*{HOST_CHAR})?"
STRICT_LABEL = (
    rf"(?:[xX][nN]--[a-zA-Z0-9-]*[a-zA-Z0-9]|{HOST_CHAR}++(?:-{HOST_CHAR}++)*+)"
)
PUBLIC_IPV4 = rf"(?!{PRIVATE_NET}){FIRST_BYTE}(?:\.{BYTE}){{2}}\.{LAST_BYTE}"


def _host(label: str, tail: str) -> str:
    # A label joins the possessive run only when another label follows its dot;
    # the last label is left for the top-level domain.
    return rf"(?:{label}\.(?={HOST_CHAR}))++{TLD_CHAR}{{2,}}{tail}"


def _pattern(label: str, tail: str, userinfo_stop: str) -> str:
    return (
        rf"^{SCHEME}://(?:[^{SPACE}{userinfo_stop}]+@)?"
        rf"(?:{PUBLIC_IPV4}|{_host(label, tail)}){PORT}(?:[/?#][^{SPACE}]*)?\z"
    )


URL_PATTERN = _pattern(LABEL, r"\.?", "")
STRICT_URL_PATTERN = _pattern(STRICT_LABEL, "", "/?#")


_PYTHON_PATTERN = re.compile(
    re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: chr(int(m[1], 16)), URL_PATTERN).replace(r"\z", r"\Z")
)


def is_url_text(value: str) -> bool:
    """``is_url`` of one value, for code that runs in Python workers anyway."""
    return _PYTHON_PATTERN.match(value) is not None


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_url(col: Column | str, strict: bool = False) -> Column:
    """True for a public http/https/ftp URL, NULL for NULL.

    ``strict`` also rejects consecutive hyphens (punycode labels excepted), a dot
    after the top-level domain, and user names that run into the path.
    """
    return as_column(col).rlike(STRICT_URL_PATTERN if strict else URL_PATTERN)


def is_url_array(col: Column | str, strict: bool = False) -> Column:
    """AND of ``is_url`` over the non-NULL elements; NULL when there are none."""
    array = as_column(col)
    return F.when(
        F.exists(array, lambda x: x.isNotNull()),
        F.forall(array, lambda x: F.coalesce(is_url(x, strict), F.lit(True))),
    )


def is_url_shlist(col: Column | str, strict: bool = False) -> Column:
    """``is_url_array`` over a list separated by single spaces; NULL for ''."""
    text = as_column(col)
    return F.when(
        text != "", F.forall(F.split(text, " ", -1), lambda x: is_url(x, strict))
    )


def reject_reason(col: Column | str) -> Column:
    """Name of the first grammar clause a text breaks; NULL for a valid URL.

    One of ``null scheme userinfo host domain tld trailing_dot private_ipv4
    reserved_ipv4 ipv4_edge ipv4_malformed port path``.
    """
    url = as_column(col)
    return (
        F.when(url.isNull(), "null")
        .when(is_url(url), F.lit(None).cast("string"))
        .otherwise(broken_clause(url))
    )


def broken_clause(col: Column | str) -> Column:
    """``reject_reason`` of a text known to be no valid URL."""
    url = as_column(col)
    return clause_of(url, *authority_parts(url))


def authority_parts(url: Column) -> tuple[Column, Column, Column]:
    """User name, host and port (with its colon) of a text that may not be a URL."""
    authority = F.regexp_extract(url, rf"^{SCHEME}://([^/?#]*)", 1)
    userinfo = F.regexp_extract(authority, r"(?s)^(.*@)", 1)
    host_port = F.substring_index(authority, "@", -1)
    host = F.substring_index(host_port, ":", 1)
    return userinfo, host, F.substring(host_port, F.length(host) + 1, F.length(host_port))


def clause_of(url: Column, userinfo: Column, host: Column, port: Column) -> Column:
    """The broken clause, from the text and its ``authority_parts``."""
    bad_port = ~port.rlike(rf"^{PORT}\z")
    return (
        F.when(url.isNull(), "null")
        .when(~url.rlike(f"^{SCHEME}://"), "scheme")
        .when(userinfo.rlike(f"^@|[{SPACE}]"), "userinfo")
        .when(
            host.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"),
            F.when(host.rlike(f"^{PRIVATE_NET}"), "private_ipv4")
            .when(host.rlike(r"^(?:0+|22[4-9]|2[34][0-9]|25[0-5])\."), "reserved_ipv4")
            .when(host.rlike(r"\.(?:0+|255)\z"), "ipv4_edge")
            .when(~host.rlike(rf"^{PUBLIC_IPV4}\z"), "ipv4_malformed")
            .when(bad_port, "port")
            .otherwise("path"),
        )
        .when(host.rlike(r"^[0-9.]*[0-9]\z"), "ipv4_malformed")
        .when(~host.rlike(rf"^{LABEL}(?:\.|\z)"), "host")
        .when(host.rlike(r"\.\.\z"), "trailing_dot")
        .when(~host.rlike(rf"^(?:{LABEL}\.(?=.))*+{LABEL}\.?\z"), "domain")
        .when(~host.rlike(rf"\.{TLD_CHAR}{{2,}}\.?\z"), "tld")
        .when(bad_port, "port")
        .otherwise("path")
    )
