import hashlib
import random
import re
import time

import pytest

from tests.llm.frames import empty, messy
from tidemark.llm import secrets
from tidemark.llm.common import shared_folder

ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
    r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(8)
    parts = ["password", "PassWd", "secret", "to", "token", "ToKEN", "api_key", "apikey", "ſecret", "toKen", " ",
             "=", ":", '"', "'", "abc", "abcdef", "0123456789abcdef01234567", "AKIA", "ABCDEFGHIJKLMNOPQRST", "é", "\n",
             "-", "ghp_" + "a" * 36, "://u:pass@", "-----BEGIN RSA PRIVATE KEY-----"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in secrets.scan(text) if s[1] < 3] == base_spans(text), text


def test_more_kinds_are_found():
    text = "x -----BEGIN RSA PRIVATE KEY----- y https://me:hidden@host xoxb-1234567890ab"
    kinds = [secrets.RULES[s[1]].kind for s in secrets.scan(text)]
    assert kinds == ["private_key", "url_password", "slack"]


def versions(spark, rows):
    return spark.createDataFrame(rows, "path long, text string")


def runs(spark, ledger):
    return spark.read.schema(secrets.LEDGER).parquet(f"{ledger}/run-*")


def test_only_unseen_blobs_and_rules_are_scanned(spark):
    ledger = shared_folder(spark, "test-ledger")
    key = 'token = "abcdef123456"'
    first = versions(spark, [(1, key), (2, key), (3, "nothing"), (4, None), (4, key)])
    few = secrets.RULES[:2]
    found = secrets.scan_versions(first, ledger, few).collect()
    assert sorted((r["path"], len(r["findings"])) for r in found) == [(1, 1), (2, 1), (3, 0), (4, 0), (4, 1)]
    assert runs(spark, ledger).count() == 3
    # nothing new: nothing is scanned, the findings are the same
    assert sorted(map(repr, secrets.scan_versions(first, ledger, few).collect())) == sorted(map(repr, found))
    assert runs(spark, ledger).count() == 3
    # a new blob alone
    more = versions(spark, [(1, key), (9, "AKIA" + "Z" * 16)])
    assert {r["path"]: len(r["findings"]) for r in secrets.scan_versions(more, ledger, few).collect()} == {1: 1, 9: 1}
    assert runs(spark, ledger).count() == 4
    # a new rule is scanned on every blob that is there, and it alone
    again = secrets.scan_versions(first, ledger, secrets.RULES[:3]).collect()
    assert len(again) == 5
    assert sum(r["rules"] == [secrets.RULES[2].version] for r in runs(spark, ledger).collect()) == 3


def test_only_the_asked_rules_are_tried(monkeypatch):
    tried = []
    find = secrets.re.finditer
    monkeypatch.setattr(secrets.re, "finditer", lambda p, *rest: tried.append(p) or find(p, *rest))
    secrets.scan("AKIA" + "A" * 16, secrets.RULES, [secrets.RULES[1].version])
    assert tried == [secrets.RULES[1].pattern]


def test_rule_versions_follow_the_pattern():
    rule = secrets.RULES[1]
    assert rule.version == rule._replace().version
    assert rule.version != rule._replace(least=21).version


def test_messy_and_empty_tables(spark):
    docs = messy(spark)
    rows = secrets.scan_versions(
        docs.selectExpr("doc_id AS path", "text"), shared_folder(spark, "test-ledger")
    ).collect()
    assert len(rows) == docs.count()
    want = {hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in docs.collect()}
    assert {r["blob"] for r in rows} == want
    none = empty(spark).selectExpr("doc_id AS path", "text")
    assert secrets.scan_versions(none, shared_folder(spark, "test-ledger")).collect() == []


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_the_plain_patterns(spark, sf):
    names = ("assign", "access", "hex")
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = secrets.op10_secret_scan(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r["doc_id"]])
        told = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(told.split(",")) - {""} <= set(r["spans"].split(","))


def found(kind, text):
    return [text[s[0] : s[2]] for s in secrets.scan(text) if secrets.RULES[s[1]].kind == kind]


@pytest.mark.parametrize(
    "url",
    [
        "https://me:" + "p" * 66 + "@",
        "https://" + "m" * 90 + ":hidden@",
        "redis://:s3cretpw99@",
        "postgres://me:a/b@c:d@",
        "a-scheme+of.more-than-twenty-letters://me:hidden@",
        "https://me@example.org:hidden@",
        "HTTPS://me:hidden@",
    ],
)
def test_url_passwords_are_whole(url):
    assert found("url_password", f"see {url}cache:6379/0 and https://example.org:80/x") == [url]
    assert found("url_password", f"x={url}h") == [url]


def test_urls_without_a_password_have_none():
    for text in ("https://example.org/a:b@c", "http://host:8080/x y@z", "http://u:@host", "://", "a://b"):
        assert found("url_password", text) == []


@pytest.mark.parametrize("name", ["PRIVATE KEY", "RSA PRIVATE KEY", "PGP PRIVATE KEY BLOCK", "OPENSSH PRIVATE KEY"])
def test_private_keys_are_whole(name):
    key = f"-----BEGIN {name}-----\nMIIabc+/=\n\nxyz==\n-----END {name}-----"
    assert found("private_key", f"a\n{key}\nb {key} c") == [key, key]
    cut = key[: key.index("-----END")]
    assert found("private_key", f"a\n{cut}") == [cut]


def test_long_runs_take_no_quadratic_time():
    begin = time.monotonic()
    for text in ("http://localhost:3000/x," * 40_000, "a.b-c+" * 200_000, "-----BEGIN " * 100_000, "a://" * 200_000):
        assert found("url_password", text) == found("private_key", text) == []
    assert time.monotonic() - begin < 20
