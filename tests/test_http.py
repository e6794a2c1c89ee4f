"""The HTTP transport, over replaced open functions; no network is used."""

import base64
import pickle
import socket
import urllib.error

import pytest

from linkloom.operators import AttemptSettings
from linkloom.sources import HttpTransport
from linkloom.sources import http as http_source


class Answer:
    def __init__(self, body):
        self.body = body

    def __enter__(self):
        return self

    def __exit__(self, *error):
        return False

    def read(self):
        return self.body


class Opener:
    def __init__(self, *outcomes):
        self.outcomes, self.seen = list(outcomes), []

    def __call__(self, request, timeout):
        self.seen.append((request, timeout))
        outcome = self.outcomes.pop(0)
        if isinstance(outcome, Exception):
            raise outcome
        return Answer(outcome)


def call(opener, url="http://a.com/x", **settings):
    waits = []
    transport = HttpTransport(open=opener, sleep=waits.append)
    return transport(url, 0, AttemptSettings(**settings)), waits


def test_success_and_timeout():
    opener = Opener(b"hello")
    assert call(opener, timeout=2.5)[0] == b"hello"
    assert opener.seen[0][1] == 2.5
    opener = Opener(b"hello")
    call(opener, timeout=0)
    assert opener.seen[0][1] is None


def test_transport_errors_are_tried_again_with_growing_waits():
    down = urllib.error.URLError("down")
    opener = Opener(down, socket.timeout(), down, b"up")
    body, waits = call(opener, tries=4, waitretry=2)
    assert body == b"up" and waits == [1, 2, 2]
    assert call(Opener(down, down), tries=2)[0] is None
    assert call(Opener(down, down, b"up"), tries=0)[0] == b"up"


def test_error_answers_are_not_tried_again():
    opener = Opener(urllib.error.HTTPError("http://a.com", 404, "gone", {}, None), b"no")
    assert call(opener, tries=5)[0] is None
    assert len(opener.seen) == 1


@pytest.mark.parametrize(
    "url,sent",
    [
        ("http://例子.测试/路?q=é#f", "http://xn--fsqu00a.xn--0zwm56d/%E8%B7%AF?q=%C3%A9"),
        ("http://a.com:8080/%41(b)", "http://a.com:8080/%41(b)"),
    ],
)
def test_urls_are_sent_in_ascii(url, sent):
    opener = Opener(b"x")
    call(opener, url)
    assert opener.seen[0][0].full_url == sent


def test_user_names():
    opener = Opener(b"x", b"x")
    call(opener, "http://me:p%40w@a.com/")
    request = opener.seen[0][0]
    assert request.full_url == "http://a.com/"
    assert request.get_header("Authorization") == "Basic " + base64.b64encode(b"me:p@w").decode()
    call(opener, "ftp://me:pw@a.com/f")
    assert opener.seen[1][0].full_url == "ftp://me:pw@a.com/f"


def test_unsendable_url_is_a_failure():
    assert call(Opener(b"x"), "http://" + "a" * 70 + ".com/")[0] is None


def test_defects_are_not_hidden():
    with pytest.raises(TypeError):
        call(Opener(TypeError("defect")))


@pytest.mark.parametrize("address,public", [("93.184.216.34", True), ("10.0.0.1", False), ("::1", False)])
def test_strict_checks_the_resolved_address(monkeypatch, address, public):
    monkeypatch.setattr(http_source.socket, "getaddrinfo", lambda *a: [(0, 0, 0, "", (address, 80))])
    if public:
        http_source._require_public("http://a.com/")
    else:
        with pytest.raises(OSError):
            http_source._require_public("http://a.com/")
        assert HttpTransport(strict=True)("http://a.com/", 0, AttemptSettings()) is None


def test_picklable():
    assert pickle.loads(pickle.dumps(HttpTransport(strict=True))) == HttpTransport(strict=True)
