"""The resolver and the fetcher against servers on this machine, and the crawl by batches."""

from __future__ import annotations

import gzip
import socket
import struct
import sys
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kontora import schema as S
from kontora.functions.rules import MAX_BODY_BYTES
from kontora.operators import crawl
from kontora.sources import internet as I
from kontora.sources import network as N
from kontora.sources.tables import Snapshots

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers have no tests
ZONE = {("shop.test", 1): [b"\x7f\x00\x00\x01"], ("shop.test", 15): [struct.pack(">H", 20) + b"\x06backup\xc0\x0c", struct.pack(">H", 10) + b"\x02mx\x04mail\x04test\x00"], ("big.test", 1): [b"\x7f\x00\x00\x01"]}


def reply(question, tcp=False):
    name, after = I._name(question, 12)
    kind = struct.unpack_from(">H", question, after)[0]
    own, body = name.rstrip("."), question[12 : after + 4]
    if own == "broken.test":
        return question[:2] + struct.pack(">HHHHH", 0x8182, 1, 0, 0, 0) + body
    if own == "big.test" and not tcp:
        return question[:2] + struct.pack(">HHHHH", 0x8380, 1, 0, 0, 0) + body
    found = ZONE.get((own, kind), [])
    code = 3 if not found and own not in {n for n, _ in ZONE} else 0
    head = question[:2] + struct.pack(">HHHHH", 0x8180 | code, 1, len(found), 0, 0)
    return head + body + b"".join(b"\xc0\x0c" + struct.pack(">HHIH", kind, 1, 60, len(x)) + x for x in found)


@pytest.fixture(scope="module")
def dns():
    udp = socket.socket(socket.AF_INET, socket.SOCK_DGRAM)
    udp.bind(("127.0.0.1", 0))
    port = udp.getsockname()[1]
    tcp = socket.create_server(("127.0.0.1", port))

    def serve():
        while True:
            try:
                data, at = udp.recvfrom(4096)
            except OSError:
                return
            if b"silent" not in data:
                udp.sendto(reply(data), at)

    def serve_tcp():
        while True:
            try:
                link, _ = tcp.accept()
            except OSError:
                return
            with link, link.makefile("rb") as f:
                answer = reply(f.read(struct.unpack(">H", f.read(2))[0]), True)
                link.sendall(struct.pack(">H", len(answer)) + answer)

    for run in (serve, serve_tcp):
        threading.Thread(target=run, daemon=True).start()
    yield port
    udp.close()
    tcp.close()


def test_resolver(dns):
    r = I.UdpResolver(["127.0.0.1"], 0.5, dns)
    assert r.a("shop.test") and r.a("big.test")
    assert r.mx("shop.test") == [("backup.shop.test.", 20), ("mx.mail.test.", 10)]
    for name in ("none.test", "big.test"):
        with pytest.raises(N.NoAnswer):
            r.mx(name)
    for name, problem in (("silent.test", "Timeout"), ("broken.test", "NoNameservers")):
        with pytest.raises(N.Transient, match=problem):
            r.a(name)
    assert N.looked_up(r.a, "a..b")[1] == "ValueError"
    with pytest.raises(ValueError):
        I._name(b"\xc0\x00", 0)


class Site(BaseHTTPRequestHandler):
    seen: list[str] = []

    def do_GET(self):
        Site.seen.append(self.path)
        if self.path.startswith("/loop"):
            self.send_response(302)
            self.send_header("Location", self.path + "x")
            self.end_headers()
        elif self.path == "/slow":
            threading.Event().wait(1.5)
        elif self.path == "/robots.txt":
            self.answer(b"User-agent: *\nAllow: /")
        elif self.path == "/away":
            self.send_response(301)
            self.send_header("Location", "/")
            self.end_headers()
        elif self.path == "/gzip":
            self.answer(gzip.compress(b"g" * (MAX_BODY_BYTES + 5)), **{"Content-Encoding": "gzip"})
        elif self.path == "/long":
            self.answer(b"l" * (MAX_BODY_BYTES + 5))
        elif self.path == "/missing":
            self.send_error(404)
        else:
            self.answer(b'<html lang="en"><title>Shop</title><a href="/cart">c</a><img src="/p.jpg" alt="p"></html>')

    do_HEAD = do_GET

    def answer(self, body, **headers):
        self.send_response(200)
        for k, v in {"Content-Length": str(len(body)), "Content-Type": "text/html", **headers}.items():
            self.send_header(k, v)
        self.end_headers()
        if self.command == "GET":
            self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture(scope="module")
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_address[1]}"
    server.shutdown()


def test_fetcher(site):
    f = I.HttpFetcher(1, 0.4)
    home = f.get(site + "/away")
    assert (home.status, home.final_url, home.error) == (200, site + "/", None) and home.body.startswith(b"<html")
    assert len(f.get(site + "/long").body) == len(f.get(site + "/gzip").body) == MAX_BODY_BYTES
    assert f.get(site + "/missing").status == 404
    Site.seen.clear()
    assert f.get(site + "/loop").error == "too_many_redirects" and len(Site.seen) == 4
    Site.seen.clear()
    assert f.get(site + "/slow").error == N.TIMEOUT and Site.seen == ["/slow"] * 2
    Site.seen.clear()
    assert f.get(site + "/slow", retry_timeout=False, budget_s=0.2).error == N.TIMEOUT and Site.seen == ["/slow"]
    assert f.get("http://127.0.0.1:1/").error == "ConnectionRefusedError" and f.get("ftp://x/").error == "ValueError"
    got = f.head(site + "/p.jpg")
    assert got.status == 200 and got.body == b"" and N.image_head(got)[1] == "text/html"


def test_crawl_by_batches(spark, tmp_path, dns, site):
    """Three stages through the real resolver and fetcher; names lead to this machine."""
    table = Snapshots(spark, str(tmp_path / "t"))
    rows = [(d, d, 0, "pending", "PERMISSIVE", "x@" + d) for d in ("shop.test", "none.test", "silent.test")] + [("u@gmail.com", "gmail.com", 1, "freemail", "OTHER", "u@gmail.com")]
    table.write(spark.createDataFrame(rows, "target_key string, domain string, is_freemail int, status string, jurisdiction string, email string"))
    port = dns
    assert crawl.run_dns(table, lambda: I.UdpResolver(["127.0.0.1"], 0.2, port), concurrency=2, retries=0, batch=2) == 3
    assert table.versions() == [1, 2]  # a snapshot for each batch, of which two are kept
    got = {r.target_key: (r.dns_resolves, r.has_mx, r.status, r.dns_attempts) for r in table.read().collect()}
    assert got == {"shop.test": (1, 1, "pending", 1), "none.test": (0, 0, "dead", 1), "silent.test": (None, None, "pending", 1), "u@gmail.com": (None, None, "freemail", 0)}

    class Local(I.HttpFetcher):
        """Names are of no server here."""

        def _followed(self, method, url, ends):
            return super()._followed(method, url.replace("https://shop.test", site), ends)

    assert crawl.run_http(table, lambda: Local(1, 1), concurrency=2) == 1
    r = table.read().filter("domain = 'shop.test'").first()
    assert (r.status, r.http_status, r.page_title, r.has_cart, r.lang) == ("live", 200, "Shop", 1, "en")
    table.write(table.read().withColumn("final_url", F.lit("https://shop.test/")))
    assert crawl.run_profile(table, lambda: Local(1, 1), concurrency=2) == 1
    r = table.read().filter("domain = 'shop.test'").first()
    assert (r.image_count, r.images_no_alt, r.has_meta_desc, r.profile_error, r.sample_image_type) == (1, 0, 0, None, "text/html")
    assert crawl.run_profile(table, lambda: Local(1, 1), concurrency=2) == 0
    assert S.TARGETS.fieldNames() == table.read().columns
