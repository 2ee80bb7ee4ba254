"""Client settings over HTTP, from a server in this process."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from conformity.sources.layout import ConfigError, HttpConfig


@pytest.fixture
def server():
    """A server whose answers are a list of (status, body); it keeps what it was asked."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            made.asked.append((self.path, {k.lower(): v for k, v in self.headers.items()}))
            status, body = made.answers.pop(0) if len(made.answers) > 1 else made.answers[0]
            self.send_response(status)
            if status == 429:
                self.send_header("Retry-After", "0")
            self.end_headers()
            self.wfile.write(body if isinstance(body, bytes) else json.dumps(body).encode())

        def log_message(self, *args):
            pass

    made = HTTPServer(("127.0.0.1", 0), Handler)
    made.answers, made.asked = [], []
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield made
    made.shutdown()


def config(server, **about):
    return HttpConfig(f"http://127.0.0.1:{server.server_port}/rest/v1/", {"apikey": "hidden"}, pause=0.01, timeout=5, **about)


def test_rows_are_asked_for_by_client(server):
    server.answers = [(200, [{"active": True, "entities": None, "overrides": {}}, {"active": False}])]
    assert config(server).platform("a b&c", "crm") == {"active": True, "entities": None, "overrides": {}}
    (path, headers), *_ = server.asked
    assert urlparse(path).path == "/rest/v1/client_platforms_by_slug" and headers["apikey"] == "hidden"
    assert parse_qs(urlparse(path).query) == {"client_slug": ["eq.a b&c"], "platform": ["eq.crm"], "select": ["active,entities,overrides"]}


def test_platforms_need_at_least_one_row_and_policies_exactly_one(server):
    policy = {"schema_version": 1, "tables": {}}
    server.answers = [(200, [])]
    with pytest.raises(LookupError, match="crm for client c"):
        config(server).platform("c", "crm")
    for answer in ([], [{"resolution_config": policy}] * 2, [{"resolution_config": None}], [{"resolution_config": "x"}], [{}]):
        server.answers = [(200, answer)]
        with pytest.raises(ValueError, match="exactly one"):
            config(server).policy("c")
    server.answers = [(200, [{"resolution_config": policy}])]
    assert config(server).policy("c") == policy


def test_what_may_pass_is_tried_again(server):
    server.answers = [(503, b""), (429, b""), (500, b""), (200, [{"active": True}])]
    assert config(server).platform("c", "p") == {"active": True} and len(server.asked) == 4
    server.answers = [(502, b"")]
    server.asked.clear()
    with pytest.raises(ConfigError, match="502 after 4 attempts") as e:
        config(server).platform("c", "p")
    assert len(server.asked) == 4 and "hidden" not in str(e.value) + repr(config(server))
    for status in (401, 404):  # will not pass
        server.answers, server.asked = [(status, b"")], []
        with pytest.raises(ConfigError, match=f"{status} after 1"):
            config(server).policy("c")
        assert len(server.asked) == 1


def test_other_answers_are_told_from_settings(server):
    for body, said in ((b"<html>", "not JSON"), ({"message": "x"}, "not a list"), ([1], "not a list")):
        server.answers = [(200, body)]
        with pytest.raises(ConfigError, match=said):
            config(server).policy("c")
    closed = config(server, attempts=2)
    server.server_close()
    server.shutdown()
    with pytest.raises(ConfigError, match="no answer after 2"):
        closed.policy("c")
