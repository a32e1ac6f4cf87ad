"""SimHash, substring and line dedup against plain restatements."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from gondola.llm import common, simhash, substring
from gondola.llm.components import component_labels
from gondola.llm.linededup import documents_without_later_lines, line_dedup
from gondola.llm.simhash import one_per_component, simhash_components
from gondola.llm.substring import substring_dedup

from .rows import SCHEMA, awkward_documents, clashing, documents, key, passage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits):
    """prints: (id, fingerprint); the smallest id in reach of each."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, p) in enumerate(prints):
        for j in range(i):
            if (p ^ prints[j][1]).bit_count() <= max_bits:
                parent[root(i)] = root(j)
    ids = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            ids[root(i)] = min(d, ids.get(root(i), d))
    return [ids.get(root(i)) for i in range(len(prints))]


def test_fingerprints_and_components(spark):
    rows = awkward_documents()
    prints = [(r[0], plain_print(r[1])) for r in rows]
    want = [(d, f"{p:016x}", c) for (d, p), c in zip(prints, plain_components(prints, 2))]
    got = simhash_components(clashing(documents(spark))).collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert simhash_components(documents(spark, [])).collect() == []


def test_broadcasts_are_bound_by_rows_and_bytes(spark):
    def hinted(df, **bounds):
        plan = common.small(df, **bounds)._jdf.queryExecution().analyzed().toString()
        return "strategy=broadcast" in plan

    df = spark.createDataFrame([(i, "x" * 1000) for i in range(50)], "i int, t string")
    assert hinted(df) and hinted(df.limit(0)) and hinted(df, rows=50)
    assert not hinted(df, rows=49) and not hinted(df, size=50_000)


def test_chunks_of_a_text_give_the_same_words(monkeypatch):
    text = " ".join(passage(5, 400)) + " \t " + " ".join(passage(6, 100))
    whole = simhash.fingerprint(text, 3), substring.window_hashes(text, 13)
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    assert simhash.fingerprint(text, 3) == whole[0]
    h1, h2, n = substring.window_hashes(text, 13)
    assert n == whole[1][2] == 500
    assert (h1 == whole[1][0]).all() and (h2 == whole[1][1]).all()


@pytest.mark.parametrize(("max_bits", "pair_rows"), [(1, 5), (2, 1), (2, 5), (2, 1000), (3, 5)])
def test_links_are_all_pairs_in_reach(spark, max_bits, pair_rows):
    """Buckets compared pair by pair, narrowed once and narrowed to the end find the same links."""
    rng = np.random.default_rng(7)
    centres = [int(x) for x in rng.integers(0, 2**63, 6)]
    prints = set(centres) | {0}
    for c in centres:
        for _ in range(25):
            flips = rng.choice(64, rng.integers(1, 4), replace=False)
            prints.add(c ^ sum(1 << int(b) for b in flips))
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    edges = simhash.links(df, max_bits, pair_rows)
    near = {(a, b) for a in signed for b in signed
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits}
    assert sorted(map(tuple, edges.collect())) == sorted(near)
    labels = {r.node: r.label for r in component_labels(edges).collect()}
    want = plain_components([(p, p % (1 << 64)) for p in signed], max_bits)
    assert [labels.get(p, p) for p in signed] == want


def test_a_chain_goes_within_all_of_its_budgets():
    masks = simhash._masks(2)
    assert [len(simhash._flips(masks, 2, 0, n)) for n in (1, 2, 3)] == [
        1, 1 + 21, 1 + 22 + 231 + 21 * (1 + 22)]
    for start in range(3):
        for flip in simhash._flips(masks, 2, start, 3):
            used = [(flip & masks[(start + k) % 3]).bit_count() for k in range(3)]
            assert used[0] == 0 and used[1] <= 1 and sum(used) <= 2


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    assert {r.label for r in component_labels(edges).collect()} == {0}


def test_one_per_component(spark):
    rows = awkward_documents()
    kept = one_per_component(documents(spark)).collect()
    prints = [plain_print(r[1]) for r in rows]
    group = dict(zip(prints, plain_components(list(enumerate(prints)), 2)))
    ids = {}
    for r, p in zip(rows, prints):
        ids.setdefault(group[p], []).append(r[0])
    want = [(g, min((i for i in own if i is not None), default=None)) for g, own in ids.items()]
    assert sorted((group[plain_print(r.text)], r.doc_id) for r in kept) == sorted(want)
    assert kept[0].__fields__ == ["doc_id", "text", "lang", "source", "n_chars"]
    assert one_per_component(documents(spark, [])).collect() == []


def test_rows_without_ids_keep_their_components(spark):
    """Rows are chosen by component, not by id: null and repeated ids lose nothing else."""
    texts = [" ".join(passage(s)) for s in range(60, 66)]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (5, texts[2]),
            (7, texts[3]), (7, texts[4]), (8, texts[4]), (7, texts[3]), (6, texts[5]), (9, texts[5])]
    df = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    kept = one_per_component(df).collect()
    want = [(None, texts[0]), (None, texts[1]), (5, texts[2]), (7, texts[3]), (7, texts[4]),
            (6, texts[5])]
    assert sorted((r[:2] for r in kept), key=key) == sorted(want, key=key)
    group = dict(corpus_pipeline.STAGES)["simhash near-dedup"]
    staged = group(spark, df, "").collect()
    assert sorted((r[:2] for r in staged), key=key) == sorted(want, key=key)


def plain_substring(rows, width):
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in split:
        if d is not None:
            for k in range(len(w) - width + 1):
                run = tuple(w[k:k + width])
                first[run] = min(first.get(run, d), d)
    out = []
    for d, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            if d is not None and first[tuple(w[k:k + width])] < d:
                gone.update(range(k, k + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("flush", [1 << 22, 40])
def test_substring_dedup(spark, monkeypatch, flush):
    monkeypatch.setattr(substring, "FLUSH", flush)
    monkeypatch.setattr(substring, "SKETCH_FLUSH", flush)
    got = substring_dedup(clashing(documents(spark)).repartition(3)).collect()
    want = plain_substring([r[:2] for r in awkward_documents()], 13)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_substring_dedup_with_a_full_sketch(spark, monkeypatch):
    """A sketch too small to tell windows apart loses no repeated one."""
    monkeypatch.setattr(substring, "CELLS_PER_BYTE", 0.0)
    monkeypatch.setattr(substring, "SEGMENT", 64)
    got = substring_dedup(documents(spark)).collect()
    want = plain_substring([r[:2] for r in awkward_documents()], 13)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert substring_dedup(documents(spark, [])).collect() == []


@pytest.mark.parametrize("wide", [True, False])
def test_packed_cells(wide):
    rng = np.random.default_rng(3)
    cells = np.unique(rng.integers(0, 4 * substring.SEGMENT, 700).astype(np.uint64))
    packed = substring._packed(cells, 5, wide).to_pylist()
    back = [int(p) + s * substring.SEGMENT for s, x in enumerate(packed)
            for p in substring._places(x, wide)]
    assert back == cells.tolist()


def plain_lines(rows):
    """rows in the order of occurrence: id, text."""
    seen, out = set(), []
    for d, t in rows:
        if t is None:
            out.append((d, 0, 0, None))
            continue
        lines = t.split("\n")
        solid = [i for i, x in enumerate(lines) if WORD.search(x)]
        gone = set()
        for k in range(len(solid) - 2):
            places = solid[k:k + 3]
            run = tuple(lines[i] for i in places)
            gone |= set(places) if run in seen else set()
            seen.add(run)
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((d, len(lines), len(gone), left))
    return out


def test_line_dedup(spark):
    rows = [r[:2] for r in awkward_documents()]
    got = line_dedup(clashing(documents(spark))).collect()
    # Nulls come first; of the rows with one id no other has windows of three lines.
    want = plain_lines(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert line_dedup(documents(spark, [])).collect() == []


def test_line_dedup_of_overlaps_and_twins(spark):
    poem = [f"line {i}" for i in range(8)]
    rows = [(1, "\n".join(poem)), (1, "\n".join(poem)), (2, "\n".join(poem[2:6] + ["own"])),
            (3, "a\n" * 6 + "a"), (4, "\n\n".join(poem[4:8]))]
    got = {(r.doc_id, r.n_removed, r.text) for r in line_dedup(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {(1, 0, "\n".join(poem)), (2, 4, "own"), (3, 6, "a"), (4, 4, "\n\n")}


def test_documents_without_later_lines(spark):
    out = documents_without_later_lines(documents(spark))
    assert out.schema.simpleString() == documents(spark).schema.simpleString()
    lines = {r.doc_id: r for r in out.filter("doc_id IN (11, 12, 13)").collect()}
    assert lines[12].text == "first line" and lines[12].n_chars == 10
    assert lines[13].text == "\nlast line"


def test_schema_is_that_of_the_tables():
    assert SCHEMA.startswith("doc_id bigint, text string")
