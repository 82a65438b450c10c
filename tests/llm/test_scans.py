"""Secrets, URL templates and shards against brute force."""

import base64
import hashlib
import json
import os
import re
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from larder.llm import queries, secrets, sharding, urls
from larder.llm.common import table
from llm_small import AWKWARD, SF_DIR

SF_MORE = "/root/testdata/sf0.01"

# fixed values: the plain patterns
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute_spans(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, k, b in sorted(spans)]


def plain(text):
    return [s for s in secrets.find(text) if s[0] in ("assign", "access", "hex")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "token", "api_key", "apikey", "ſecret", "toKen", "=", ": ", '"', "'", " ",
                                 "abc", "deadbeef00", "AKIA", "ABCDEFGH12345678", "é", "\n"]), max_size=25).map("".join))
def test_plain_spans(text):
    assert plain(text) == brute_spans(text)


def test_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF_MORE, "documents").collect()}
    rows = {r.doc_id: r for r in queries.op6_secret_scan(spark, SF_MORE).collect()}
    assert rows.keys() == texts.keys()
    for d, t in texts.items():
        spans = brute_spans(t)
        kinds = [k for k, _, _ in spans]
        assert [rows[d].n_assign, rows[d].n_access, rows[d].n_hex] == [kinds.count(k) for k in ("assign", "access", "hex")]
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert rows[d].base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(rows[d].spans.split(","))
    assert any(r.spans for r in rows.values())


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + size + body


def ssh(data):
    return len(data).to_bytes(4, "big") + data


NUMBER = der(2, b"\x01" * 64)
RSA = der(0x30, der(2, b"\0"), *[NUMBER] * 8)
EC = der(0x30, der(2, b"\1"), der(4, b"\x07" * 32), der(0xA0, der(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x03"), der(5)), der(4, RSA))
PUBLIC = der(0x30, der(0x30, der(6, b"\x2a\x03"), der(5)), der(3, b"\0" + b"\x11" * 70))
SSH = b"openssh-key-v1\0" + ssh(b"none") + ssh(b"none") + ssh(b"") + (1).to_bytes(4, "big") + ssh(b"p" * 51) + ssh(b"s" * 136)


def b64(data):
    return base64.b64encode(data).decode()


def jwt(header, payload, signature=b"s" * 32):
    return ".".join(base64.urlsafe_b64encode(x).decode().rstrip("=") for x in
                    (json.dumps(header).encode(), json.dumps(payload).encode(), signature))


def test_confirmed_structures():
    for data, kind in ((RSA, "der_key"), (EC, "der_key"), (PKCS8, "der_key"), (SSH, "ssh_key")):
        text = f"é see {b64(data)} there"
        assert [(kind, 6, 6 + len(b64(data)))] == [s for s in secrets.find(text) if s[0] == kind]
        hexed = f"x {data.hex()} y"
        assert [s[0] for s in secrets.find(hexed)] == ["hex", kind]
    body = "\n".join(re.findall(".{1,64}", b64(RSA)))
    pem = f"-----BEGIN RSA PRIVATE KEY-----\n{body}\n-----END RSA PRIVATE KEY-----"
    assert secrets.find(f"a {pem} b") == [("pem_key", 2, 2 + len(pem))]
    token = jwt({"alg": "HS256", "typ": "JWT"}, {"sub": "1"})
    assert secrets.find(f"a {token} b") == [("jwt", 2, 2 + len(token))]


def test_layouts_of_keys():
    boxed = der(0x30, der(0x30, der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d"), der(0x30, der(5))), der(4, b"\x5a" * 128))
    def pem(name, data, line, head=""):
        return f"-----BEGIN {name}-----{line}{head}" + line.join(re.findall(".{1,64}", b64(data))) + f"{line}-----END {name}-----"
    for text in (pem("PRIVATE KEY", PKCS8, "\\n"), pem("PRIVATE KEY", PKCS8, "\\r\\n"), pem("ENCRYPTED PRIVATE KEY", boxed, "\n"),
                 pem("RSA PRIVATE KEY", b"\x5a" * 640, "\n", "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123456789ABCDEF0123456789ABCDEF\n\n")):
        assert [s for s in secrets.find(f'é "{text}"') if s[0] != "hex"] == [("pem_key", 3, 3 + len(text))]
    for data, kind in ((RSA, "der_key"), (EC, "der_key"), (PKCS8, "der_key"), (boxed, "der_key"), (SSH, "ssh_key")):
        for width, line in ((64, "\n"), (76, "\r\n"), (64, "\\n"), (64, "\n    ")):
            text = line.join(re.findall(f".{{1,{width}}}", b64(data)))
            for before, after in (("see: ", " x"), ("-----BEGIN PRIVATE KEY-----" + line, f"{line}next line"), ("x" * 40 + "+", "")):
                assert secrets.find(before + text + after) == [(kind, len(before), len(before + text))]
    box = der(0x30, der(0x30, der(6, b"\x60\x86\x48\x01\x65\x03\x04\x02\x01"), der(5)), der(4, b"\x5a" * 32))
    for data in (box, PUBLIC, RSA[:8] + b"\x41" + RSA[9:]):
        assert secrets.find("\n".join(re.findall(".{1,64}", b64(data)))) == []


def test_lookalikes_are_not_reported():
    for data in (RSA[:-1], RSA + b"\0", RSA[:8] + b"\x41" + RSA[9:], PUBLIC, SSH[:-1], SSH + b"\0", os.urandom(200)):
        assert secrets._key_kind(data) is None
    for token in (jwt({"typ": "JWT"}, {}), jwt({"alg": "none"}, {}), jwt(["alg"], {}), jwt({"alg": "HS256"}, [1]),
                  jwt({"alg": "HS256"}, {}, b"short")):
        assert [s for s in secrets.find(token) if s[0] == "jwt"] == []
    assert secrets.find("-----BEGIN RSA PRIVATE KEY-----\nabc") == []


def test_repeated_marks_take_time_in_proportion():
    marks = {"ssh": b64(b"openssh-key-v1\0" + ssh(b"none") + b"\x7f\xff\xff\xff!!"), "pem": "-----BEGIN RSA PRIVATE KEY-----\n"}
    for mark in marks.values():
        took = []
        for n in (1000, 8000):
            started = time.perf_counter()
            assert secrets.find(mark * n) == []
            took.append(time.perf_counter() - started)
        assert took[1] < 24 * took[0] + 0.5
    text = "\n".join([*[b64(SSH)] * 300, marks["pem"] * 300])
    assert [k for k, _, _ in secrets.find(text)] == ["ssh_key"] * 300


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80) | st.sampled_from([RSA, EC, PKCS8, SSH]).flatmap(
    lambda d: st.integers(0, len(d) - 1).map(lambda k: d[:k] + bytes([d[k] ^ 0x55]) + d[k + 1:])))
def test_parsers_never_fail(data):
    secrets._key_kind(data)
    secrets.find(b64(data) + "." + b64(data) + "." + b64(data))


def test_masking(spark, awkward, nothing):
    text = f"a password=abcdef12 b {b64(EC)} AKIA{'A' * 20} c"
    assert secrets.masked(text) == "a [SECRET] b [SECRET] [SECRET] c"
    assert secrets.masked("token = \"" + "0f" * 20 + "\"") == "[SECRET]\""
    docs = awkward.withColumn("n_chars", F.length("text").cast("bigint"))
    rows = secrets.mask(docs.union(docs.limit(1).withColumn("text", F.lit(text)))).collect()
    assert len(rows) == len(AWKWARD) + 1 and rows[0].asDict().keys() == set(docs.columns)
    assert all((r.n_chars is None) == (r.text is None) and r.n_chars in (None, len(r.text or "")) for r in rows)
    assert secrets.mask(nothing).collect() == [] == secrets.scan(nothing).collect()
    assert len(secrets.digests(secrets.scan(awkward)).collect()) == len(AWKWARD)


def brute_rule(host, path):
    best = None
    for verdict, rule in queries.URL_RULES:
        h, p = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return best or (None, None)


def test_url_query(spark):
    pages = {r.page_id: r.url for r in table(spark, SF_DIR, "pages").select("page_id", "url").collect()}
    rows = queries.op5_url_filter(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", pages[r.page_id])
        assert (r.host, r.path) == (m[1].lower(), m[2])
        verdict, rule = brute_rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ((verdict,) if verdict else ("allow", "block"))


def pages_of(spark, rows):
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, b) for i, (_, b) in enumerate(rows) if b is not None], "page_id bigint, bad boolean")
    return pages.withColumns({"host": F.lit("x"), "n": F.lit(1), "template": F.lit("y")}), labels


def test_templates_generalise_and_are_rejected_by_purity(spark):
    rows = [(f"http://a.org/good/{i}/x", False) for i in range(300)] + [(f"http://a.org/spam/{i}/x", True) for i in range(300)]
    rows += [(f"http://a.org/news/{i}/x", False) for i in range(300)]
    rows += [(f"http://b.org/u/{'qwertyuiop'[i % 10]}{'asdfghjklz'[i // 10 % 10]}{'xcvbnmqwe'[i % 9]}/p", i % 5 == 0) for i in range(400)]
    rows += [("http://a.org/spam/999999/x", None), ("http://a.org/good/7.html", None), ("nothing", None), (None, None), ("://", None)]
    pages, labels = pages_of(spark, rows)
    out = {r.page_id: r for r in urls.judge(pages, labels, []).collect()}
    assert len(out) == len(rows)
    for i, (u, bad) in enumerate(rows[:900]):
        assert out[i].verdict == ("block" if bad else "allow")
    assert out[0].template == out[600].template and out[0].template.startswith("/(good|news)/")
    assert out[300].template.startswith("/spam/") and out[1300].verdict == "block"
    assert {out[i].template for i in range(900, 1300)} == {"/u/*/p"}
    assert all((out[i].host, out[i].path, out[i].verdict) == ("", "", "allow") for i in (1302, 1303, 1304))


def test_many_sections_keep_their_own_verdicts(spark):
    name = [f"{a}{b}" for a in "abcdefg" for b in "qrstuvw"]
    rows = [(f"http://a.org/{name[s]}/{i}", s == 7) for s in range(40) for i in range(30)]
    rows += [(f"http://b.org/main/{i}", False) for i in range(2000)]
    rows += [(f"http://b.org/{name[s]}/{i}", s == 7) for s in range(40) for i in range(30)]
    rows += [(f"http://c.org/u/{a}{b}{c}/{i}", i == 0) for a in "abcde" for b in "fghij" for c in "klm" for i in range(6)]
    out = {r.page_id: r for r in urls.judge(*pages_of(spark, rows), []).collect()}
    assert [out[i].verdict for i in range(len(rows))][:4400] == ["block" if bad else "allow" for _, bad in rows[:4400]]
    assert out[210].template == "/bq/{n}" and {out[i].template for i in range(4400, len(rows))} == {"/u/*/{n}"}


def test_chains_of_shares_are_cut(spark):
    rows = [(f"http://a.org/{'abcdefghijk'[s]}/{i}", i < 2 * s) for s in range(11) for i in range(20)]
    rows += [(f"http://b.org/main/{i}", False) for i in range(2000)]
    rows += [(f"http://b.org/{'abcdefghijklmnop'[s - 5]}/{i}", i < s) for s in range(5, 21) for i in range(20)]
    out = {r.page_id: r for r in urls.judge(*pages_of(spark, rows), []).collect()}
    for clean, bad in ((0, 200), (2220, 2520)):
        assert {out[i].verdict for i in range(clean, clean + 20)} == {"allow"}
        assert {out[i].verdict for i in range(bad, bad + 20)} == {"block"}


def test_no_member_of_a_branch_differs_from_another():
    for counts in ([(20, 2 * s) for s in range(11)], [(5, 0)] + [(1000, 25 * s) for s in range(41)],
                   [(lab, bad) for lab in (5, 17, 60, 300) for bad in range(lab + 1)]):
        counts = sorted(counts, key=lambda c: (c[1] / c[0], c[0]))
        found = urls.numbered(counts)
        assert found == sorted(found) and len(set(found)) > 1
        assert not any(urls.differs(b, n, b_0, n_0) for (n, b), x in zip(counts, found)
                       for (n_0, b_0), y in zip(counts, found) if x == y)


def test_the_plan_of_a_round_is_small(spark):
    children = spark.createDataFrame([], "host string, template array<string>, child string, lab bigint, bad bigint")
    plan = urls.labels(children)._jdf.queryExecution().analyzed()
    # how often the children are read; the driver plans every copy, and again after every stage
    assert plan.collectLeaves().size() <= 4


def test_depth_has_no_end(spark):
    deep = "/".join("abcdefghij")
    rows = [(f"http://a.org/{deep}/{['good', 'spam'][i % 2]}/{i}/x", bool(i % 2)) for i in range(100)]
    rows += [(f"http://a.org/{deep}/other/" + "y/" * i, None) for i in range(300)]
    out = {r.page_id: r for r in urls.judge(*pages_of(spark, rows), []).collect()}
    assert [out[i].verdict for i in range(100)] == ["block" if bad else "allow" for _, bad in rows[:100]]
    assert out[1].template == f"/{deep}/spam/{{n}}/x"


def test_urls_without_labels_and_rows(spark):
    pages, labels = pages_of(spark, [("http://A.Example.com/en/1?x#y", None), ("HTTP://www.example.com/en/" + "d/" * 5000, None)] * 2)
    rows = urls.judge(pages, labels, queries.URL_RULES).collect()
    assert sorted((r.host, r.rule, r.verdict) for r in rows) == [("a.example.com", "example.com/en/", "block")] * 2 + [
        ("www.example.com", "www.example.com/en/", "allow")] * 2
    assert urls.judge(pages.where("false"), labels, []).collect() == []


def brute_jump(key, n):
    key &= 2 ** 64 - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2 ** 64
        j = int((b + 1) * (2.0 ** 31 / ((key >> 33) + 1)))
    return b


def test_shards_query(spark, texts):
    rows = queries.op4_jump_sharding(spark, SF_DIR).collect()
    check_shards(rows, texts.items(), 24)
    assert all(r.law == "key" for r in rows)


def check_shards(rows, texts, n):
    want = sorted(((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), brute_jump(d or 0, n), brute_jump(d or 0, n + 1))
                   for d, t in texts), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in rows), key=repr) == want
    assert all(r.grown_shard in (r.shard, n) for r in rows)
    for s in range(n):
        inside = sorted((r.slot, r.doc_id if r.doc_id is not None else -2 ** 63) for r in rows if r.shard == s)
        assert [a for a, _ in inside] == list(range(len(inside)))
        assert [d for _, d in inside] == sorted(d for _, d in inside)


def test_awkward_shards(awkward, nothing):
    for n in (1, 24, 1000):
        check_shards(sharding.shard(awkward, n).collect(), AWKWARD, n)
    check_shards(sharding.shard(awkward, 3, chunks=2).collect(), AWKWARD, 3)
    assert sharding.shard(nothing, 24).collect() == []


def test_jump_on_many_keys(spark):
    keys = [0, 1, -1, 2 ** 63 - 1, -2 ** 63, *range(1000, 3000)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = df.select("k", *[sharding.jump(F.col("k"), n).alias(str(n)) for n in (1, 2, 24, 25)]).collect()
    assert all(r[str(n)] == brute_jump(r.k, n) for r in got for n in (1, 2, 24, 25))


def test_no_python_in_sharding(spark, documents):
    plan = sharding.shard(documents, 24)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
