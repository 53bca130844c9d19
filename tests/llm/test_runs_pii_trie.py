"""Periodic runs, personal data and the prefix trie against plain Python; edge cases."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from oracle_compare import connect, differences
from pyspark.sql import functions as F

from tripstrata.llm import periodic_runs, pii, prefix_trie
from tripstrata.llm.queries import ORACLE, QUERIES
from tripstrata.llm.scan import running

SF_DIR = "/root/testdata/sf0.01"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- periodic runs -----------------------------------------------------------


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = 0
        while start + q < len(words):
            stop = start + q
            while stop < len(words) and words[stop] == words[stop - q]:
                stop += 1
            if stop - start >= max(6, 4 * q):
                found.setdefault((start, stop), q)
            start = stop - q + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def numbers(words):
    return periodic_runs.word_numbers([str(w).encode() for w in words])


def test_runs_equal_a_plain_search_on_random_words():
    chance = random.Random(5)
    for _ in range(600):
        words = [chance.randrange(chance.choice([1, 2, 3, 9])) for _ in range(chance.randrange(60))]
        for _ in range(chance.randrange(3)):
            part = [chance.randrange(4) for _ in range(chance.randrange(1, 9))]
            words[(at := chance.randrange(len(words) + 1)):at] = part * chance.randrange(2, 8)
        assert periodic_runs.runs_of_words(numbers(words)) == brute_runs(words)


def test_runs_survive_misleading_hashes(monkeypatch):
    words = [1, 2, 3] * 7 + [9] * 8 + [4, 5] * 6
    monkeypatch.setattr(periodic_runs._Segment, "reach", lambda self, start, lag: (0, len(self.words)))
    monkeypatch.setattr(periodic_runs._Segment, "agreeing_blocks", lambda self, lag: np.array([0]))
    assert periodic_runs.runs_of_words(numbers(words)) == brute_runs(words)


def test_runs_of_long_texts_take_little_time():
    chance = random.Random(1)
    begun = time.perf_counter()
    assert periodic_runs.runs_of_words(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    part = [chance.randrange(50) for _ in range(20_000)]
    assert periodic_runs.runs_of_words(numbers(part * 5)) == [(0, 100_000, 20_000)]
    prose = [chance.randrange(1 + chance.randrange(5000)) for _ in range(300_000)]
    periodic_runs.runs_of_words(numbers(prose))
    assert time.perf_counter() - begun < 60


def test_segments_hold_frequent_words_only():
    assert periodic_runs.frequent_segments(numbers("a b a b a b a b x a a a a a a".split())) == [(0, 8), (9, 15)]
    assert periodic_runs.frequent_segments(numbers("a b c d e f g".split())) == []


def test_runs_edges(spark):
    texts = [None, "", "  \n", "a", "x " * 5, "x " * 6, "a b\n" * 4, "a b " * 9, "é 中 " * 5 + "tail", "a b a b a b a b a b"]
    rows = [(n, t) for n, t in enumerate(texts)] + [(9, texts[9]), (None, texts[9])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "runs": F.lit(2)})
    found = sorted(periodic_runs.find_runs(frame).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.n_words for r in found] == [0, 0, 0, 1, 5, 6, 8, 9, 11, 10, 10, 10]
    assert [[tuple(x) for x in r.runs] for r in found] == [
        [], [], [], [], [], [(0, 6, 1)], [(0, 8, 2)], [(0, 9, 1)], [(0, 10, 2)], *[[(0, 10, 2)]] * 3]
    assert [r.collapsed for r in found[4:9]] == ["x x x x x", "x", "a b", "a b", "é 中 tail"]
    assert periodic_runs.find_runs(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="four"):
        periodic_runs.find_runs(frame, exponent=3)


def test_rebuilt_tails(spark):
    rows = [(n, " ".join(f"w{k}" for k in range(n % 50))) for n in range(200)] + [(None, "a b"), (300, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for r in frame.select("doc_id", "text", periodic_runs.repeated_tails("text", "doc_id").alias("new")).collect():
        words = (r.text or "").split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if r.doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r.new.split() == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        else:
            assert r.new == (r.text or "")


# -- personal data -----------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_pii(text):
    def passes(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(part) <= 255 for part in found.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            return 12 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = [
        (m.start(), list(PATTERNS).index(kind), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]
    return [f"{list(PATTERNS)[k]}:{s}:{e}" for s, k, e in sorted(found)]


def base_of(spans):
    return [f"{kind}:{start}:{end}" for start, end, kind in spans if kind in pii.BASE]


def test_base_spans_equal_the_patterns_on_random_texts():
    chance = random.Random(3)
    alphabets = ["0123456789 .-+()", "01.", "ab@.-1", "a@b.c%+-_ é", "12+() -.", "0123456789"]
    seen = set()
    for _ in range(6000):
        letters = chance.choice(alphabets)
        text = "".join(chance.choice(letters) for _ in range(chance.randrange(70)))
        found = base_of(pii.find_spans(text))
        assert found == brute_pii(text), text
        seen |= {f.split(":")[0] for f in found}
    assert seen == set(pii.BASE)


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("see https://joe:s3cret@host.example/x", "login", "joe:s3cret"),
        ("at http://[2001:db8::1]:80/ now", "ip6", "2001:db8::1"),
        ("IBAN: DE89 3704 0044 0532 0130 00 thanks", "iban", "DE89 3704 0044 0532 0130 00"),
        ("iban GB82WEST12345698765432 NEXT WORDS", "iban", "GB82WEST12345698765432"),
        ("my SSN 123-45-6789.", "ssn", "123-45-6789"),
        ("account no. 12345678 x", "account", "12345678"),
        ("\U0001f600 Konto: 77 88 99 11", "account", "77 88 99 11"),
        ("http://[zz::1]/", None, ""), ("IBAN DE88 3704 0044 0532 0130 00", None, ""), ("SSN 000-45-6789", None, ""),
        ("SSN 123-45-67890", None, ""), ("accounts 12345678", None, ""), ("account 123", None, ""), ("account12345678", None, ""),
        ("://joe:pw@host", None, ""), ("time 12:30 and http://host:80/", None, ""),
    ],
)
def test_cues_add_spans(text, kind, value):
    added = [(k, text[s:e]) for s, e, k in pii.find_spans(text) if k not in pii.BASE]
    assert added == ([(kind, value)] if kind else [])


def test_pii_edges(spark):
    long = ("nothing here, " * 20_000) + "joe@example.com" + " 1" * 200_000
    texts = [None, "", "a", "joe@example.com", "call +1 (017) 555-7713 or 10.0.0.1", long, "@" * 5000, "1." * 5000, "+1" * 5000]
    rows = [(n, t) for n, t in enumerate(texts)] + [(3, texts[3]), (None, texts[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "spans": F.lit(2)})
    found = pii.scan_pii(frame, mask=True).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for n, text in enumerate(texts):
        assert [f"{s.kind}:{s.start}:{s.end}" for s in by_id[n].spans] == brute_pii(text)
    assert by_id[None].masked == "<email>" and by_id[0].masked == "" and by_id[4].masked == "call <phone> or <ip>"
    assert pii.scan_pii(frame.limit(0)).count() == 0


def test_pii_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    found = QUERIES["op12_pii"](spark, SF_DIR).collect()
    assert len(found) == len(docs)
    for r in found:
        base = brute_pii(docs[r.doc_id])
        assert r.base_sha256 == sha(",".join(base)) and set(base) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k) for b in base) for k in pii.BASE]
    assert any(r.n_email for r in found) and any(r.n_phone for r in found)


# -- prefix trie -------------------------------------------------------------


def brute_trie(conversations):
    """Nodes of ``{id: [(role, text), ...]}``, by walking every prefix."""
    members, size = defaultdict(list), {}
    for c in sorted(conversations):
        turns = conversations[c]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            size[tuple(turns[:d])] = len(turns[d - 1][1].encode()) if d else 0
    rows = []
    for node, own in members.items():
        below = [x for x in members if x[: len(node)] == node]
        parents = {x[:-1] for x in members if x}
        ends = ",".join(str(c) for c in own if len(conversations[c]) == len(node))
        rows.append((
            own[0], len(node), members[node[:-1]][0] if node else None, len(own),
            sum(1 for x in members if x and x[:-1] == node), sum(x not in parents for x in below),
            sum((len(members[x]) - 1) * size[x] for x in below), sha(ends),
        ))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def rebuilt(conversations):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = conversations.get(c - c % 5, [])[:h] + turns[h:]
    return out


def rows_of(nodes):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted([tuple(r[n] for n in names) for r in nodes.collect()], key=lambda r: (r[1], r[0]))


def frame_of(spark, conversations, **more):
    rows = [(c, n, *turn) for c, turns in conversations.items() for n, turn in enumerate(turns)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.withColumns({k: F.lit(v) for k, v in more.items()}).repartition(3)


@pytest.mark.parametrize("block", [1, 2, 4])
def test_trie_equals_a_walk_over_prefixes(spark, block):
    chance = random.Random(block)
    conversations = {
        c: [("ua"[n % 2], chance.choice("xyé")) for n in range(chance.randrange(1, 10))] for c in range(60)
    } | {c: [("u", "x"), ("a", "y")] * 4 + [("u", str(c // 8))] for c in range(100, 130)}
    turns = prefix_trie.number_turns(frame_of(spark, conversations, pos=1, conv=2, k1=3, digest="d"))
    assert rows_of(prefix_trie.build_trie(prefix_trie.as_they_are(turns), block)) == brute_trie(conversations)


def test_trie_edges(spark):
    long = [("u", str(n % 7)) for n in range(1500)]
    conversations = {7: [("u", "a")], 11: [("", "")], 13: [("u", "a")] * 2, 50: long, 51: long[:1400] + [("a", "z")], -3: [("u", "q")]}
    rows = [(c, n, *turn) for c, turns in conversations.items() for n, turn in enumerate(turns) if c != 11]
    # Null turns come first, ties go by role, rows of no conversation take no part.
    rows += [(11, None, None, None), (90, 1, "u", "b"), (90, None, "u", "a"), (90, 1, "a", "c"), (None, 0, "u", "a")]
    conversations[90] = [("u", "a"), ("a", "c"), ("u", "b")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    shared = prefix_trie.share_heads(prefix_trie.number_turns(frame))
    expected = rebuilt(conversations)
    assert any(not turns for turns in expected.values())
    found = rows_of(prefix_trie.build_trie(shared))
    small = {c: t for c, t in expected.items() if len(t) < 100}
    brute = {(r[1], r[0]): r for r in brute_trie(small)}
    by_node = {(r[1], r[0]): r for r in found}
    assert len(found) == len({tuple(t[:d]) for t in expected.values() for d in range(len(t) + 1)})
    for key, row in brute.items():
        if key[1] not in (50, 51, -3) and key[0] > 0:
            assert by_node[key][2:5] == row[2:5] and by_node[key][7] == row[7]
    assert by_node[1400, 50][3:6] == (2, 2, 2) and by_node[1500, 50][3:7] == (1, 0, 1, 0)
    assert by_node[1399, 50][6] == 2 and by_node[0, -3][3] == len(conversations)
    assert prefix_trie.build_trie(prefix_trie.share_heads(prefix_trie.number_turns(frame.limit(0)))).count() == 0


def test_only_turnless_conversations(spark):
    frame = spark.createDataFrame([(c, 0, "u", "a") for c in (1, 2, 3, 4)], "conv_id long, turn long, role string, text string")
    heads = prefix_trie.share_heads(prefix_trie.number_turns(frame))
    silent = [c for c in (1, 2, 3, 4) if zlib.crc32(str(c).encode()) % 9]
    found = rows_of(prefix_trie.build_trie(heads.filter(F.col("conv").isin(silent))))
    assert found == [(min(silent), 0, None, len(silent), 0, 1, 0, sha(",".join(map(str, silent))))]


def test_running_values_of_keys_that_span_tasks(spark):
    rows = [(7, n, n * n % 101) for n in range(3000)] + [(k, n, k) for k in range(20) if k != 7 for n in range(k)]
    frame = spark.createDataFrame(rows, "key long, at long, value long").repartition(7)
    found = running(frame, "key", ["at"], count="number", sums={"value": "sum"}, xors={"at": "bits"})
    assert found.columns == ["key", "at", "value", "number", "sum", "bits"]
    for key, group in [(k, [r for r in rows if r[0] == k]) for k in (7, 19, 1)]:
        got = sorted(found.filter(F.col("key") == key).collect(), key=lambda r: r.at)
        assert [r.number for r in got] == list(range(1, len(group) + 1))
        assert [r.sum for r in got] == list(np.cumsum([r[2] for r in group]))
        assert [r.bits for r in got] == list(np.bitwise_xor.accumulate([r[1] for r in group]))
    assert found.count() == len(rows)


@pytest.mark.parametrize("name", ["op11_periodic_runs", "op13_conversation_trie"])
def test_new_queries_match_sql(spark, name):
    con = connect(SF_DIR)
    assert differences(spark, con, QUERIES[name], ORACLE[name], SF_DIR) == []
