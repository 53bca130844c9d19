"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tiktoken
import tokenizers

from tripstrata.llm import bpe

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = re.compile("[A-Z]+")
_SECRETS = {
    "assign": re.compile(
        "((?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
        + "|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(_UPPER.sub(lambda m: m[0].lower(), text or ""))


def secrets(text: str | None) -> tuple:
    found = []
    for number, (kind, pattern) in enumerate(_SECRETS.items()):
        for m in pattern.finditer(text or ""):
            long_enough = {"assign": lambda: len(m[2]) >= 8, "access": lambda: len(m[0]) >= 16, "hex": lambda: len(m[0]) >= 32}
            if long_enough[kind]():
                found.append((m.start(), number, m.end(), kind))
    found.sort()
    counts = Counter(f[3] for f in found)
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in found)
    return counts["assign"], counts["access"], counts["hex"], sha(listed)


def secret_spans(text: str) -> list[tuple]:
    """(start, number, end, kind) of all findings of a text whose values have one owner."""
    found = []
    for number, (kind, pattern) in enumerate(_SECRETS.items()):
        least = {"assign": 8, "access": 16, "hex": 32}[kind]
        found += [(m.start(), number, m.end(), kind) for m in pattern.finditer(text) if len(m[pattern.groups]) >= least]
    covered = {at for start, _, end, _ in found for at in range(start, end)}
    for m in re.finditer("[A-Za-z0-9+/_-]{20,}", text):
        value = m[0]
        mixed = sum(c.isdigit() for c in value) > 1 and value.upper() != value != value.lower()
        live = len(set(value)) >= 8 and not re.search("example|sample|dummy|changeme|placeholder|your[_-]|xxxx|1234567", value, re.I)
        if mixed and live and covered.isdisjoint(range(*m.span())):
            found.append((m.start(), 3, m.end(), "opaque"))
    return sorted(found)


def redacted(text: str, spans: list[tuple]) -> str:
    out, at = [], 0
    for start, _, end, _ in spans:
        out += [] if start < at else [text[at:start], "<secret>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def windows(items: list[tuple], size: int = 13) -> dict[tuple, set[str]]:
    owners = defaultdict(set)
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w and item is not None else 0):
            owners[tuple(w[k : k + size])].add(str(item))
    return owners


def contamination(text: str | None, owners: dict[tuple, set[str]]) -> tuple:
    w, hit, items = words(text), set(), set()
    for size in {len(k) for k in owners}:
        for k in range(len(w) - size + 1):
            if found := owners.get(tuple(w[k : k + size])):
                hit.update(range(k, k + size))
                items |= found
    bad = bool(hit) and 20 * len(hit) >= len(w)
    return len(w), len(hit), len(items), sha(",".join(sorted(items))), bad


def token_counts(texts: list[str]) -> list[int]:
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def bpe_library() -> tiktoken.Encoding:
    ranks = dict(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_row(library: tiktoken.Encoding, text: str | None) -> tuple:
    ids = library.encode_ordinary(text or "")
    packed = np.array(ids, "<u4").tobytes()
    return len(ids), sha(packed), sha((text or "").encode())


def measures(text: str | None) -> tuple:
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    found = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    times, covered = Counter(found), set()
    for k, window in enumerate(found):
        if times[window] > 1:
            covered.update(range(k, k + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def repeats(texts: list[str | None], size: int = 400) -> list[tuple]:
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + size] for b in raw for i in range(len(b) - size + 1))
    rows = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if times[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        rows.append((len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return rows


def near_classes(rows: list[tuple[int, str | None]], least: float = 0.8) -> dict[int, int]:
    """Class of each id, its least id: closed under plain Jaccard similarity."""
    sets = {}
    for key, text in rows:
        w = words(text)
        sets[key] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset([text or ""])
    parent = {key: key for key in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners, shared = defaultdict(list), Counter()
    for key, found in sets.items():
        for s in found:
            owners[s].append(key)
    for keys in owners.values():
        for n, a in enumerate(keys):
            for b in keys[:n]:
                shared[b, a] += 1
    for (a, b), n in shared.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= least:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {key: root(key) for key in sets}


def _characters(text: str | None) -> list[str]:
    return ["0" if "0" <= c <= "9" else c for c in " ".join((text or "").split())]


def kneser_ney(train: list[str], texts: list[str]) -> list[float | None]:
    """Log perplexities under interpolated modified Kneser-Ney of order 3."""
    three = Counter()
    for text in train:
        c = ["\2", "\2", *_characters(text)]
        three.update(zip(c, c[1:], c[2:]))
    two = Counter((b, c) for _, b, c in three)
    one = Counter(c for _, c in two)

    def discounts(counts):
        n = Counter(counts.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        found = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] and n[k + 1] else 0.5 * k for k in (1, 2, 3)]
        found = [min(max(d, 0.05 * k), 0.95 * k) for k, d in enumerate(found, 1)]
        return lambda n: found[min(n, 3) - 1] if n else 0.0

    d3, d2, d1 = discounts(three), discounts(two), discounts(one)
    contexts = defaultdict(lambda: [0, 0.0])
    for gram, n in three.items():
        contexts[gram[:2]][0] += n
        contexts[gram[:2]][1] += d3(n)
    for gram, n in two.items():
        contexts[gram[:1]][0] += n
        contexts[gram[:1]][1] += d2(n)
    total, free = sum(one.values()), sum(map(d1, one.values()))

    def p(gram):
        n = one[gram[-1]]
        value = (n - d1(n) + free / (len(one) + 1)) / total
        for counts, d, part in ((two, d2, gram[1:]), (three, d3, gram)):
            if part[:-1] in contexts:
                all_, mass = contexts[part[:-1]]
                n = counts[part]
                value = (n - d(n) + mass * value) / all_
        return value

    out = []
    for text in texts:
        c = ["\2", "\2", *_characters(text)]
        logs = [math.log(p(g)) for g in zip(c, c[1:], c[2:])]
        out.append(-sum(logs) / len(logs) if logs else None)
    return out


def page_languages(docs: list[tuple], pages: list[tuple]) -> dict:
    """``(lang, confidence)`` of each page id from (tag, text) and (id, url, html), by the stated formula."""
    from tripstrata.llm import language_id as m

    counts: dict[str, np.ndarray] = {}
    for tag, text in docs:
        if tag and re.fullmatch(r"\s*[A-Za-z]{2,3}([-_][A-Za-z0-9_-]*)?\s*", tag):
            code = re.split("[-_]", tag.strip().lower())[0]
            counts.setdefault(code, np.zeros(m.CELLS))
            for cell in m.trigram_cells(text or ""):
                counts[code][cell] += 1
    languages = sorted(counts)
    logs = np.array([np.log((counts[x] + m.SMOOTH) / (counts[x] + m.SMOOTH).sum()) for x in languages])
    rows = []
    for key, url, body in pages:
        logp = m.TEMPER * logs[:, m.trigram_cells(m.visible_text(body or ""))].sum(axis=1)
        share = np.exp(logp - logp.max())
        host, domain, suffix, path = m.address_parts(url or "")
        rows.append((key, logp, share / share.sum(), {
            "host": host, "domain": domain, "suffix": suffix, "path": path, "declared": m.declared_language(body or ""), "all": ""}))
    sums = {name: defaultdict(lambda: np.zeros(len(languages))) for name in rows[0][3]}
    for _, _, share, facts in rows:
        for name, value in facts.items():
            sums[name][value] += share
    found = {}
    for key, logp, share, facts in rows:
        prior = np.full(len(languages), 1 / len(languages))
        for level in ("all", "suffix", "domain", "host"):
            others = np.maximum(sums[level][facts[level]] - share, 0)
            prior = (others + m.STRENGTH * prior) / (others.sum() + m.STRENGTH)
        score = logp + np.log(prior)
        for name in ("declared", "suffix", "path"):
            if facts[name]:
                score = score + np.log((sums[name][facts[name]] + m.NOISE) / (sums["all"][""] + m.NOISE * len(sums[name])))
        best = int(np.argmax(score))
        found[key] = (languages[best], 1 / np.exp(score - score[best]).sum())
    return found
