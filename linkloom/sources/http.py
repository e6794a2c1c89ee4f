"""GET over http, https and ftp for the live fetch stage."""

from __future__ import annotations

import base64
import http.client
import ipaddress
import socket
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from linkloom.operators.policy import AttemptSettings


def _require_public(url: str) -> None:
    """Raise OSError unless every address of the URL's host is public."""
    parts = urllib.parse.urlsplit(url)
    for info in socket.getaddrinfo(parts.hostname, parts.port or 80):
        if not ipaddress.ip_address(info[4][0].split("%")[0]).is_global:
            raise OSError(f"{parts.hostname} has an address that is not public")


class _PublicRedirects(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, req, fp, code, msg, headers, newurl):
        _require_public(newurl)
        return super().redirect_request(req, fp, code, msg, headers, newurl)


SCHEMES = ("http", "https", "ftp")


def _opener(redirects: type[urllib.request.HTTPRedirectHandler]) -> urllib.request.OpenerDirector:
    """An opener for http, https and ftp alone: no local files, no inline data."""
    opener = urllib.request.OpenerDirector()
    for handler in (
        urllib.request.ProxyHandler,
        urllib.request.HTTPHandler,
        urllib.request.HTTPSHandler,
        urllib.request.FTPHandler,
        urllib.request.HTTPDefaultErrorHandler,
        urllib.request.HTTPErrorProcessor,
        urllib.request.UnknownHandler,
        redirects,
    ):
        opener.add_handler(handler())
    return opener


def _request(url: str) -> urllib.request.Request:
    """Host in IDNA form, the rest percent-encoded, user name as a header."""
    parts = urllib.parse.urlsplit(url)
    user, at, host = parts.netloc.rpartition("@")
    name, colon, port = host.partition(":")
    host = name.encode("idna").decode("ascii") + colon + port
    headers = {}
    if at and parts.scheme.lower() != "ftp":  # ftp logs in from the URL itself
        plain = urllib.parse.unquote(user if ":" in user else user + ":").encode()
        headers["Authorization"] = "Basic " + base64.b64encode(plain).decode("ascii")
        user = at = ""

    def quote(text: str) -> str:
        return urllib.parse.quote(text, safe="%/:=&?~#+!$,;'@()*[]")

    ascii_url = urllib.parse.urlunsplit(
        (parts.scheme, quote(user) + at + host, quote(parts.path), quote(parts.query), "")
    )
    return urllib.request.Request(ascii_url, headers=headers)


@dataclass(frozen=True)
class HttpTransport:
    """Callable ``(url, attempt, settings) -> bytes | None``; None is a failure.

    ``timeout`` covers connecting and each read.  ``tries`` repeats transport
    errors but not error answers such as 404; URLs of other schemes fail, waiting 1, 2, ... up to
    ``waitretry`` seconds.  Redirects are followed.  ``strict`` refuses hosts
    that resolve to private addresses.  ``open`` and ``sleep`` are replaceable.
    """

    strict: bool = False
    open: Callable | None = None
    sleep: Callable[[float], None] = time.sleep

    def _open(self, request: urllib.request.Request, timeout: float | None):
        if self.open is not None:
            return self.open(request, timeout=timeout)
        if self.strict:
            _require_public(request.full_url)
            return _opener(_PublicRedirects).open(request, timeout=timeout)
        return _opener(urllib.request.HTTPRedirectHandler).open(request, timeout=timeout)

    def __call__(self, url: str, attempt: int, settings: AttemptSettings) -> bytes | None:
        if url.partition(":")[0].lower() not in SCHEMES:
            return None
        # 0 means no limit for both settings, as usual for command-line clients.
        tried = 0
        while True:
            tried += 1
            try:
                with self._open(_request(url), settings.timeout or None) as answer:
                    return answer.read()
            except urllib.error.HTTPError:
                return None
            except (OSError, http.client.HTTPException):
                if settings.tries and tried >= settings.tries:
                    return None
                self.sleep(min(tried, settings.waitretry))
            except ValueError:  # not encodable as a request
                return None
