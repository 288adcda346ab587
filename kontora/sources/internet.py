"""A resolver and a fetcher of the standard library, for ``kontora.sources.network``."""

from __future__ import annotations

import http.client
import os
import socket
import ssl
import struct
import time
import zlib
from urllib.parse import urljoin, urlsplit

from kontora.functions.rules import MAX_BODY_BYTES
from kontora.functions.urls import AGENT
from kontora.sources.network import TIMEOUT, NoAnswer, Response, Transient

A, MX, INTERNET = 1, 15, 1
REDIRECTS = 3


def system_nameservers(path: str = "/etc/resolv.conf") -> list[str]:
    try:
        with open(path) as f:
            return [w[1] for line in f if (w := line.split())[:1] == ["nameserver"] and len(w) > 1]
    except OSError:
        return []


class UdpResolver:
    """Asks each name server in turn; a cut answer is asked for again over TCP."""

    def __init__(self, nameservers: list[str] | None = None, timeout: float = 5.0, port: int = 53):
        self.servers, self.timeout, self.port = nameservers or system_nameservers(), timeout, port

    def a(self, name: str) -> bool:
        return bool(self._ask(name, A))

    def mx(self, name: str) -> list[tuple[str, int]]:
        return [(_name(message, at + 2)[0], struct.unpack_from(">H", message, at)[0]) for message, at in self._ask(name, MX)]

    def _ask(self, name: str, kind: int) -> list[tuple[bytes, int]]:
        """(message, place of the data) of each record; raises if there is none."""
        problem = "NoNameservers"
        for server in self.servers:
            own = os.urandom(2)
            question = own + struct.pack(">HHHHH", 0x0100, 1, 0, 0, 0) + _encoded(name) + struct.pack(">HH", kind, INTERNET)
            try:
                message = self._exchange(server, question)
            except TimeoutError:
                problem = "Timeout"
                continue
            except OSError:
                continue
            code = message[3] & 15
            if code == 3:
                raise NoAnswer(name)
            if code == 0:
                found = list(_records(message, kind))
                if not found:
                    raise NoAnswer(name)
                return found
        raise Transient(problem)

    def _exchange(self, server: str, question: bytes) -> bytes:
        family = socket.AF_INET6 if ":" in server else socket.AF_INET
        with socket.socket(family, socket.SOCK_DGRAM) as s:
            s.settimeout(self.timeout)
            s.connect((server, self.port))
            s.send(question)
            ends = time.monotonic() + self.timeout
            while True:
                s.settimeout(max(0.001, ends - time.monotonic()))
                message = s.recv(4096)
                if len(message) >= 12 and message[:2] == question[:2]:
                    break
        if not message[2] & 2:
            return message
        with socket.create_connection((server, self.port), self.timeout) as s, s.makefile("rb") as f:
            s.sendall(struct.pack(">H", len(question)) + question)
            return f.read(struct.unpack(">H", f.read(2))[0])


def _encoded(name: str) -> bytes:
    labels = [label.encode("ascii") if label.isascii() else label.encode("idna") for label in name.rstrip(".").split(".")]
    if not all(0 < len(x) < 64 for x in labels):
        raise ValueError("a label is empty or too long")
    return b"".join(bytes([len(x)]) + x for x in labels) + b"\0"


def _name(message: bytes, at: int) -> tuple[str, int]:
    """A name and the place after it; pointers lead backwards only."""
    labels, after, least = [], None, at
    while size := message[at]:
        if size >= 192:
            to = struct.unpack_from(">H", message, at)[0] & 0x3FFF
            if to >= least:
                raise ValueError("a pointer that doesn't lead backwards")
            after, at, least = after or at + 2, to, to
        else:
            labels.append(message[at + 1 : at + 1 + size].decode("ascii", "replace"))
            at += 1 + size
    return ".".join(labels) + ".", after or at + 1


def _records(message: bytes, kind: int):
    questions, answers = struct.unpack_from(">HH", message, 4)
    at = 12
    for _ in range(questions):
        at = _name(message, at)[1] + 4
    for _ in range(answers):
        at = _name(message, at)[1]
        own, _, _, size = struct.unpack_from(">HHIH", message, at)
        if own == kind:
            yield message, at + 10
        at += 10 + size


class HttpFetcher:
    """GET and HEAD with separate time limits, few redirects and a cap on the body."""

    def __init__(self, connect_timeout: float = 10.0, read_timeout: float = 15.0, agent: str = AGENT):
        self.connect_timeout, self.read_timeout = connect_timeout, read_timeout
        self.headers = {"User-Agent": agent, "Accept": "text/html,application/xhtml+xml,*/*;q=0.8", "Accept-Encoding": "gzip, deflate", "Connection": "close"}
        self.context = ssl.create_default_context()

    def get(self, url: str, retry_timeout: bool = True, budget_s: float | None = None) -> Response:
        """A timeout is tried once more if it may be; any other answer stands."""
        got = self._asked("GET", url, budget_s)
        return self._asked("GET", url, budget_s) if got.error == TIMEOUT and retry_timeout else got

    def head(self, url: str) -> Response:
        return self._asked("HEAD", url, None)

    def _asked(self, method: str, url: str, budget_s: float | None) -> Response:
        began = time.monotonic()
        try:
            status, at, headers, body = self._followed(method, url, began + budget_s if budget_s else None)
        except TimeoutError:
            return Response(elapsed_ms=_since(began), error=TIMEOUT)
        except Exception as e:  # whatever a server does wrong is its answer
            return Response(elapsed_ms=_since(began), error=str(e) if isinstance(e, TooManyRedirects) else type(e).__name__)
        return Response(status, at, headers, body, _since(began))

    def _followed(self, method: str, url: str, ends: float | None):
        for _ in range(REDIRECTS + 1):
            status, headers, body = self._once(method, url, ends)
            target = headers.get("location")
            if status not in (301, 302, 303, 307, 308) or not target:
                return status, url, headers, body
            url = urljoin(url, target)
        raise TooManyRedirects("too_many_redirects")

    def _once(self, method: str, url: str, ends: float | None):
        def left(limit: float) -> float:
            rest = limit if ends is None else min(limit, ends - time.monotonic())
            if rest <= 0:
                raise TimeoutError
            return rest

        parts = urlsplit(url)
        if parts.scheme not in ("http", "https") or not parts.hostname:
            raise ValueError("no web address")
        options = {"context": self.context} if parts.scheme == "https" else {}
        kind = http.client.HTTPSConnection if options else http.client.HTTPConnection
        link = kind(parts.hostname, parts.port, timeout=left(self.connect_timeout), **options)
        try:
            link.connect()
            link.sock.settimeout(left(self.read_timeout))
            link.request(method, (parts.path or "/") + (f"?{parts.query}" if parts.query else ""), headers=self.headers)
            answer = link.getresponse()
            headers = {k.lower(): v for k, v in answer.getheaders()}
            coded = headers.get("content-encoding", "").lower()
            unpack = zlib.decompressobj(47 if coded == "gzip" else 15) if coded in ("gzip", "deflate") else None
            body = b""
            while method == "GET" and len(body) < MAX_BODY_BYTES:
                if link.sock:
                    link.sock.settimeout(left(self.read_timeout))
                part = answer.read1(16384)
                if not part:
                    break
                body += unpack.decompress(part, MAX_BODY_BYTES) if unpack else part
            return answer.status, headers, body[:MAX_BODY_BYTES]
        finally:
            link.close()


class TooManyRedirects(Exception):
    pass


def _since(began: float) -> int:
    return int((time.monotonic() - began) * 1000)
