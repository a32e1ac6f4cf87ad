"""Quality classifier, personal data, quality rules, WARC and secrets."""

import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from gondola.llm import nbsvm, pii, secrets, warc
from gondola.llm.nbsvm import quality
from gondola.llm.pii import personal_data
from gondola.llm.rules import quality_rules
from gondola.llm.secrets import scan_secrets
from gondola.llm.warc import read_records, record_bytes, warc_round_trip

from .rows import awkward_documents, clashing, documents, key, passage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- quality classifier

def labelled(spark, n=300):
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        words = passage(1000 + i, 40)
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return documents(spark, docs), spark.createDataFrame(
        labels, "doc_id bigint, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality(clashing(docs), labels).collect()
    assert len(got) == 300
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == truth[r.doc_id] for r in out)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_quality_learns_nothing_from_held_out_labels(spark):
    docs, labels = labelled(spark)
    turned = labels.withColumn("quality", F.when(nbsvm.held_out(), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_quality_edges(spark):
    docs, labels = labelled(spark, 120)
    model = nbsvm.train(docs, labels, "quality")
    scored = nbsvm.with_score(documents(spark), model).collect()
    assert len(scored) == len(awkward_documents())
    blank = {round(r.score, 12) for r in scored if not r.text}
    assert len(blank) == 1  # the bias alone
    assert quality(documents(spark, []), labels).collect() == []
    one = quality(docs, labels.filter("quality = 1"))
    assert one.select("score").distinct().count() == 1
    none = quality(docs, labels.filter("doc_id < 0")).collect()
    assert {r.score for r in none} == {0.5}


def test_dual_descent_satisfies_its_optimum():
    """No row's gradient asks for a further step within its bounds."""
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(64, 8, replace=False)).astype(np.int32) for _ in range(60)]
    labels = np.array([int((r < 32).sum() > 4) for r in rows])
    ratio = rng.normal(size=64)
    w, b = nbsvm.dual_descent(rows, labels, ratio, epochs=2000)
    y = np.where(labels > 0, 1, -1)
    margins = np.array([nbsvm.margin(r, ratio, w, b) for r in rows]) * y
    # The primal objective is no worse than at points around it.
    caps = np.array([len(y) / (2 * (y == c).sum()) for c in y])

    def loss(v, bias):
        m = np.array([(v[r] @ ratio[r]) / np.linalg.norm(ratio[r]) for r in rows]) + bias
        return (v @ v + bias * bias) / 2 + (caps * np.maximum(0, 1 - y * m)).sum()

    v = np.divide(w, ratio)
    best = loss(v, b)
    assert np.isfinite(margins).all()
    for _ in range(50):
        assert best <= loss(v + rng.normal(scale=0.02, size=64), b + rng.normal(scale=0.02)) + 1e-3


def test_features_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(passage(3, 200))
    marks = np.zeros(nbsvm.BUCKETS, bool)
    whole = nbsvm.features(text, marks)
    assert not marks.any()
    monkeypatch.setattr(nbsvm, "word_shapes", lambda block: np.zeros(0, np.uint32))
    grams = nbsvm.features(text, marks)
    assert set(grams) < set(whole)
    monkeypatch.setattr(nbsvm, "BLOCK", 50)
    assert (nbsvm.features(text, marks) == grams).all()
    assert len(nbsvm.features(None, marks)) == len(nbsvm.features("", marks)) == 0


# --- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_base(text):
    def fits(kind, s):
        digits = [int(c) for c in s if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in s.split("."))
        if kind == "card":
            total = sum(d if i % 2 == 0 else (2 * d - 9 if 2 * d > 9 else 2 * d)
                        for i, d in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in BASE.items()
            for m in re.finditer(p, text or "") if fits(k, m[0])]


PII_TEXTS = [
    "mail a.b+c@x-y.co.uk, or @x.y a@b @ a@b.c.@d.e x@y.z@w.v é@a.b",
    "1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 01.002.3.255. 1.2.3 256.1.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 5500005555555559 1",
    "+1 (663) 555-6869, +49 30 1234567, +1 2, +123456789012345678 ++1 555 123 4567",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, DE89370400440532013001",
    "my ssn is 123-45-6789 " + "and then quite far away from that word " * 2 + "987-65-4321",
    "\U0001F600 tel +1 415 555 2671",
]


def test_base_spans_and_brute_force(spark):
    rng = random.Random(2)
    texts = PII_TEXTS + ["".join(rng.choice("a1.@+- ()9é4") for _ in range(200)) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, None), (5, "")]
    df = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = personal_data(df).collect()
    for r, (i, t) in zip(sorted(got, key=lambda r: key((r.doc_id, len(r.spans)))),
                         sorted(rows, key=lambda r: key((r[0], len(r[1] or ""))))):
        assert r.doc_id == i
    by_text = {}
    for t in texts:
        base = plain_base(t)
        by_text[hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()] = base
        found = [(x.kind, x.start, x.end) for x in pii.spans_of(t)]
        assert [x for x in found if x[0] in BASE] == base
    assert {r.base_sha256 for r in got} - {hashlib.sha256(b"").hexdigest()} <= set(by_text)
    assert personal_data(documents(spark, [])).collect() == []


def test_added_kinds():
    def kinds(t, kind):
        return [t[x.start:x.end] for x in pii.spans_of(t) if x.kind == kind]

    assert kinds(PII_TEXTS[4], "iban") == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert kinds(PII_TEXTS[5], "ssn") == ["123-45-6789"]
    scores = [x.score for x in pii.spans_of("call +1 415 555 2671 " + " . " * 30 + "+1 415 555 2672")]
    assert scores[0] > scores[1]


@pytest.mark.parametrize("bad", ["a" * 200_000, "1" * 200_000, "+1" + "(" * 200_000,
                                 "a@" * 100_000, "1.1.1" * 40_000, "@" + "a" * 200_000])
def test_scans_are_linear(bad):
    pii.spans_of(bad + " @ 1")


def iban(country, body):
    """An account number with the check digits that make the remainder 1."""
    rest = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    return f"{country}{98 - rest:02d}{body}"


def test_no_valid_account_is_lost_to_a_card():
    rng = random.Random(4)
    accounts = [iban("BE", "".join(rng.choices("0123456789", k=12))) for _ in range(500)]
    covered = 0
    for a in accounts:
        spans = pii.spans_of(f"to {a} now")
        assert (3, 3 + len(a)) in {(x.start, x.end) for x in spans if x.kind == "iban"}
        covered += any(x.kind == "card" for x in spans)
    assert covered > 10  # cards stay beside them


def test_context_counts_on_both_sides_and_numbers_must_be_issued():
    def ssns(t):
        return [t[x.start:x.end] for x in pii.spans_of(t) if x.kind == "ssn"]

    assert ssns("123-45-6789 (SSN)") == ssns("ssn 123-45-6789") == ["123-45-6789"]
    assert ssns("123-45-6789" + " far" * 20 + " ssn") == []
    for bad in ("000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000"):
        assert ssns("SSN " + bad) == []
    assert ssns("SSN +1 123-45-6789") == []  # a phone covers it


def test_uncovered_spans_equal_the_plain_comparison():
    rng = random.Random(5)
    for _ in range(200):
        covers = [(s, s + rng.randint(1, 30)) for s in rng.sample(range(100), rng.randint(0, 6))]
        spans = [(s, s + rng.randint(1, 9)) for s in range(0, 120, 7)]
        want = [(s, e) for s, e in spans if not any(a < e and s < b for a, b in covers)]
        assert list(pii._uncovered(spans, covers)) == want


def test_a_long_text_of_mixed_numbers():
    """Ten megabytes with every kind; a comparison of all pairs would take hours."""
    piece = "BE71 0961 2345 6769 ssn 123-45-6789 1.2.3.4 4111 1111 1111 1111, x@y.zz +49 30 123456 . "
    n = 10_000_000 // len(piece)
    found = pii.spans_of(piece * n)
    assert sum(x.kind == "ip" for x in found) == sum(x.kind == "iban" for x in found) == n


# --- quality rules

def plain_rules(rows, limit_docs):
    def norm(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
        return " ".join(WORD.findall(low))

    having = {}
    for i, t, h in set(rows):
        for x in {norm(x) for x in (t or "").split("\n")} - {""}:
            having[h, x] = having.get((h, x), 0) + 1
    out = []
    for i, t, h in rows:
        t = t or ""
        w = WORD.findall(t)
        runs = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
        rep = {p for k, r in enumerate(runs) if runs.count(r) > 1 for p in range(k, k + 8)} \
            if len(runs) < 500 else set()
        solid = [x for x in t.split("\n") if WORD.search(x)]
        left = sum(len(WORD.findall(x)) for x in solid if having[h, norm(x)] <= limit_docs)
        failed = len(w) < 20 or 100 * len(rep) > 30 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)),
                    len(solid) - len(set(solid)), len(rep), failed,
                    not failed and 100 * left >= 30 * len(w), left))
    return out


def test_quality_rules(spark):
    common = "Common Line  of this site\tagain and again with so many words in it"
    rows = [(r[0], r[1], r[3]) for r in awkward_documents() if r[0] not in (14, 15)]
    rows += [(100 + i, (common if i % 3 else common.lower()) + "\n"
              + " ".join(passage(50 + i, 25 if i % 2 else 1)) + "\n# a | <c> &$%*", "site")
             for i in range(14)]
    rows += [(200 + i, (common + " more of it ") * 2, "site") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = quality_rules(clashing(df).drop("host"), limit_docs=10).collect()
    want = plain_rules(rows, 10)
    assert sorted((tuple(r)[:9] for r in got), key=key) == sorted(want, key=key)
    assert {r.kept for r in got if (r.doc_id or 0) >= 100} == {True, False}
    left = {r.doc_id: r.left_text for r in got}
    assert left[101] == " ".join(passage(51, 25))
    assert quality_rules(documents(spark, [])).collect() == []


def test_common_lines_of_a_large_host(spark):
    """A line in two per cent of a large host's documents is common."""
    rows = [(i, ("all rights reserved here\n" if i % 50 == 0 else "") + " ".join(passage(i, 25)), "big")
            for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = {r.doc_id: r for r in quality_rules(df).collect()}
    assert all(got[i].n_left_words == 25 and got[i].left_text == " ".join(passage(i, 25)) for i in got)


# --- WARC

def test_archive_round_trip_and_damage():
    payloads = [b"", b"x" * 10, bytes(range(256)) * 3000, "é\r\n\r\nWARC/1.1".encode()]
    members = [record_bytes(str(i), f"http://a/{i}\r\nX: y", p, None, hashlib.sha1(p).hexdigest(),
                            len(p)) for i, p in enumerate(payloads)]
    members.append(record_bytes("9", None, b"", "2", "d" * 40, 77))
    data = b"".join(members)
    records = list(read_records(io.BytesIO(data)))
    assert [r.payload for r in records[:4]] == payloads
    assert all(r.block_ok and r.payload_ok for r in records[:4])
    assert records[4].headers["warc-type"] == "revisit" and records[4].payload_ok is None
    assert records[0].headers["warc-target-uri"] == "http://a/0 X: y"
    assert list(read_records(io.BytesIO(b""))) == []
    wrong = record_bytes("1", "u", b"abc", None, "0" * 40, 3)
    assert [r.payload_ok for r in read_records(io.BytesIO(wrong))] == [False]
    for cut in (data[:-3], members[2][:-20], data[:len(members[0]) + 5]):
        with pytest.raises((ValueError, zlib.error)):
            list(read_records(io.BytesIO(cut)))


def test_pages_come_back(spark, tmp_path, monkeypatch):
    big, other = "<p>é" + "a" * 1200, "b" * 999
    rows = [(1, "http://a", big), (2, None, big), (3, "http://c", big), (4, "u", other),
            (5, "u", other), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "x\ny", "c" * 1000),
            (8, "x\ny", "c" * 1000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    more = pages.select(*[F.lit(1).alias(n) for n in ("digest", "URL", "key", "length")], "*")
    got = warc_round_trip(more, str(tmp_path / "w")).collect()
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        same = [j for j, _, k in rows if k == h and j is not None] if len(data) >= 1000 else []
        owner = max(same) if same and max(same) != i else None
        want.append((i, len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if owner else "response", owner, True))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert warc_round_trip(pages.limit(0), str(tmp_path / "e")).collect() == []


def test_small_archives(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", "x" * i) for i in range(50)],
                                  "page_id bigint, url string, html string")
    archives = warc.write_warc(pages.coalesce(1), str(tmp_path / "w"), archive_bytes=2000)
    assert archives.count() > 3 and archives.agg(F.sum("n_records")).first()[0] == 50
    back = warc.read_warc(archives).collect()
    assert sorted((int(r.page_id), r.payload) for r in back) == [
        (i, bytearray(b"x" * i)) for i in range(50)]


def test_damaged_archives_raise(spark, tmp_path):
    """Digest and length are those of the payload read, not those that a record states."""
    def archive(name, *members):
        (tmp_path / name).write_bytes(b"".join(members))
        return spark.createDataFrame([(f"file://{tmp_path}/{name}",)], "archive string")

    sound = record_bytes("1", "u", b"abc", None, hashlib.sha1(b"abc").hexdigest(), 3)
    row = warc.read_warc(archive("a", sound)).first()
    assert (row.payload_bytes, row.payload_digest) == (3, hashlib.sha1(b"abc").hexdigest())
    for name, digest, length in (("b", "0" * 40, 3), ("c", hashlib.sha1(b"abc").hexdigest(), 4)):
        wrong = archive(name, sound, record_bytes("2", "u", b"abc", None, digest, length))
        with pytest.raises(PythonException, match="isn't what its digests say"):
            warc.read_warc(wrong).collect()
        told = {r.page_id: r for r in warc.read_warc(wrong, strict=False).collect()}
        assert told["1"].payload_ok and not told["2"].payload_ok
        assert (told["2"].payload_bytes, told["2"].payload_digest) == (
            3, hashlib.sha1(b"abc").hexdigest())


def test_revisits_need_their_response(spark):
    fields = ("warc_type string, page_id string, payload_bytes bigint, payload_digest string, "
              "refers_to string")
    whole = ("response", "9", 2000, "d1", None)
    found = spark.createDataFrame([whole, ("revisit", "3", 77, "d1", "9")], fields)
    assert {r.page_id: r.payload_bytes for r in warc.with_responses(found).collect()} == {
        "9": 2000, "3": 2000}
    for lost in (("revisit", "3", 77, "d1", "8"), ("revisit", "3", 77, "d2", "9")):
        with pytest.raises(Exception, match="no such response"):
            warc.with_responses(spark.createDataFrame([whole, lost], fields)).collect()


# --- secrets

def secret_rows():
    rng = random.Random(4)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = []
    for i in range(60):
        words = " ".join(passage(300 + i, 12))
        rows.append((i, f'{words} token = "{hexa(40)}" {words}'))
        rows.append((100 + i, f"{words} {''.join(passage(900 + i, 6))} {words}"))
    rows += [(500, None), (501, ""), (None, f"api_key: {hexa(32)}"), (502, "é " + "q" * 20 + " end"),
             (503, "AKIA" + "ABCDEFGH12345678")]
    return rows


def test_secret_scan(spark):
    rows = secret_rows()
    df = spark.createDataFrame([(*r, "src/a") for r in rows], "doc_id bigint, text string, source string")
    got = scan_secrets(clashing(df)).collect()
    text = dict(rows)
    for r in got:
        assert hashlib.sha256(text[r.doc_id][r.start:r.end].encode()).hexdigest() == r.value_sha256
    judged = {(r.doc_id, r.is_secret) for r in got if r.doc_id is not None and r.doc_id < 100}
    assert judged == {(i, True) for i in range(60)}
    assert not any(r.is_secret for r in got if r.doc_id is not None and 100 <= r.doc_id < 200)
    assert [r.kind for r in got if r.doc_id == 503] == ["aws_key_id"]
    assert scan_secrets(documents(spark, [])).collect() == []


def test_secret_scan_with_given_labels(spark):
    rows = secret_rows()[:80]
    df = spark.createDataFrame([(*r, None) for r in rows], "doc_id bigint, text string, source string")
    found = scan_secrets(df)
    turned = found.select("value_sha256", (~F.col("is_secret")).alias("is_secret"))
    again = {(r.value_sha256, r.is_secret) for r in scan_secrets(df, labelled=turned).collect()}
    assert again == {(r.value_sha256, r.is_secret) for r in turned.collect()}
    one = scan_secrets(df, labelled=turned.filter("is_secret")).collect()
    assert len({r.score for r in one}) == 1


def test_mixed_values_that_nothing_names(spark):
    """Hashes and UUIDs look like secrets; they are none where texts share them unnamed."""
    rng = random.Random(6)
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    commit, uuid = hexa(40), f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}"
    rows = secret_rows() + [(1000 + i, f"{' '.join(passage(i, 6))} commit {commit} by me {i}")
                            for i in range(8)]
    rows += [(2000 + i, f"{' '.join(passage(i, 5))} id {hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)} x")
             for i in range(20)] + [(3000, f"row {uuid} end")]
    df = spark.createDataFrame([(*r, "src/a") for r in rows], "doc_id bigint, text string, source string")
    got = {(r.doc_id, r.value_sha256): r.is_secret for r in scan_secrets(df).collect()}
    sha = lambda v: hashlib.sha256(v.encode()).hexdigest()
    assert not any(got[1000 + i, sha(commit)] for i in range(8))
    assert not got[3000, sha(uuid)]
    assert all(v for (i, _), v in got.items() if i is not None and i < 60)  # the named ones


def test_the_forest_learns_from_labelled_findings(spark):
    """Held-out findings that no rule labels: tokens beside one word, checksums beside another."""
    rng = random.Random(7)
    rows, truth = [], {}
    for i in range(400):
        value = "".join(rng.choices("0123456789abcdef", k=32))
        kind = rng.random() < 0.5
        word = rng.choice(["use", "login", "bearer"]) if kind else rng.choice(["md5", "sum", "rev"])
        rows.append((i, f"{' '.join(passage(i, 5))} {word} {value} {' '.join(passage(i + 9, 4))}", "src/a"))
        truth[hashlib.sha256(value.encode()).hexdigest()] = kind
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    known = dict(list(truth.items())[:250])
    labelled = spark.createDataFrame(list(known.items()), "value_sha256 string, is_secret boolean")
    got = {r.value_sha256: r.is_secret for r in scan_secrets(df, labelled=labelled).collect()}
    held = [(got[v], kind) for v, kind in truth.items() if v not in known]
    right = sum(a == b for a, b in held) / len(held)
    called = [kind for is_secret, kind in held if is_secret]
    assert right > 0.9 and sum(called) / len(called) > 0.9
    # Rules alone label none of them, so they call all alike.
    assert len(set(r.score for r in scan_secrets(df).collect())) == 1


def test_features_equal_the_plain_ones(spark):
    rows = [(i, t) for i, t in secret_rows() if t]
    df = spark.createDataFrame([(i, t, "src/tests/a.py") for i, t in rows],
                               "doc_id bigint, text string, source string")
    found = secrets.findings(df, "doc_id", "text", "source")
    having = {}
    for r in found.collect():
        having.setdefault(r.value, set()).add(r._th)
    for r in secrets.with_features(found, df, "text").collect():
        v = r.value
        kinds = ["a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if c.isdigit() else "-"
                 for c in v]
        plain = {
            "length": len(v), "digits": sum(c.isdigit() for c in v) / len(v),
            "capitals": sum("A" <= c <= "Z" for c in v) / len(v),
            "class_changes": sum(a != b for a, b in zip(kinds, kinds[1:])) / len(v),
            "distinct": len(set(v)) / len(v), "texts": len(having[v]), "path_depth": 2,
            "path_test": 1, "quoted": float(r.before[-1:] == '"' and r.after[:1] == '"')}
        assert {k: r[k] for k in plain} == pytest.approx(plain)
        assert all(0 <= r[k] < secrets.BUCKETS for k in secrets.NOMINAL)


def test_named_values_and_dotted_tokens(spark):
    """Assigned values of any length and characters, and tokens with dots, are whole."""
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0In0.c2lnbmF0dXJlX29mX2l0"
    whole = {1: ('x password = "S3cr3t!pass" y', "S3cr3t!pass"), 2: ("api_key: a1b2c3d4, z", "a1b2c3d4"),
             3: (f"see {jwt} here", jwt), 4: ("MY_DATABASE_PASSWORD=h.nter@2$", "h.nter@2$"),
             5: ("pwd='p:w\"1'", 'p:w"1')}
    df = documents(spark, [(i, t, "en", "s", 0) for i, (t, _) in whole.items()])
    got = [(r.doc_id, whole[r.doc_id][0][r.start:r.end]) for r in scan_secrets(df).collect()]
    assert {(i, v) for i, (_, v) in whole.items()} <= set(got)
    assert [v for i, v in got if i == 3] == [jwt]
    far = ("a." * 5_000) + "b" * 20
    assert [(r.start, r.end) for r in scan_secrets(
        documents(spark, [(9, far, "en", "s", 0)])).collect()] == [(0, len(far))]


def test_transitions_are_counted_in_whole_texts(spark):
    """Words far from any finding count, and those of texts without one; findings don't."""
    token = "Zq7xK2vB9mT4wL6c"
    far = "banana " * 200
    df = documents(spark, [(1, f"{far}see {token} there {far}", "en", "s", 0),
                           (2, "coconut coconut", "en", "s", 0), (3, None, "en", "s", 0)])
    found = secrets.findings(df, "doc_id", "text", "source")
    assert [r["value"] for r in found.collect()] == [token]
    words = ["banana"] * 400 + ["see", "there", "coconut", "coconut"]
    pairs = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
    first = Counter()
    for pair, n in pairs.items():
        first[pair[0]] += n
    plain = "".join("0" if c.isdigit() else c for c in token.lower())
    own = [plain[i:i + 2] for i in range(len(plain) - 1)]
    logs = [math.log((pairs[p] + 1) / (first[p[0]] + len(secrets.CLASSES))) if p in pairs
            else secrets.UNSEEN for p in own]
    got = secrets.transition_scores(found, df, "text").collect()
    assert [(r["value"], r["transition"]) for r in got] == [(token, round(sum(logs) / len(logs), 6))]
    probe = found.withColumn("value", F.lit("banana"))
    want = [math.log((pairs[p] + 1) / (first[p[0]] + len(secrets.CLASSES)))
            for p in ("ba", "an", "na", "an", "na")]
    got = secrets.transition_scores(probe, df, "text").first()["transition"]
    assert got == pytest.approx(sum(want) / 5, abs=2e-6)
