"""Benchmark decontamination, conversation trie and dataset manifest against brute force."""

import collections
import hashlib
import random
import re
import zlib

import pytest
import xxhash

from rillweave.llm import conversation_trie, merkle, phrase_index
from rillweave.llm.common import Workspace
from rillweave.llm.queries import conversation_nodes, document_proofs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _key(row):
    return tuple((x is not None, x) for x in row)


def _rows(df, *names):
    return sorted((tuple(r[n] for n in names or df.columns) for r in df.collect()), key=_key)


def _words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- decontamination


def _leak_tables(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "中文", "naïve", "B2"]
    prose = lambda k: " ".join(rng.choices(vocabulary, k=k))
    items = [(i, prose(rng.choice([11, 14, 25])) + rng.choice([".", "!\n", ""])) for i in range(12)]
    items += [(50, "w1 w2"), (51, "W29"), (52, None), (53, " ,. "), (54, "never seen words at all in any document of this table"),
              (7, "another text of item seven with some other words in it"), (None, "no name for this item but ten words of text here"),
              (9, items[9][1]), (55, items[3][1]), (56, "w5 " * 12)]
    docs = []
    for i in range(70):
        text = prose(rng.choice([0, 1, 5, 40, 90]))
        if i % 3 == 0:
            words = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(words) + 1)
            text += rng.choice([" ", "-", "\n\t"]) + rng.choice([", ", " "]).join(words[at:] if i % 2 else words).upper() + " " + prose(3)
        docs.append((i, text))
    docs += [(100, None), (101, ""), (102, "..."), (103, "w5 " * 40), docs[0], docs[3], docs[3], (None, items[0][1]), (104, "Xw1-w2É" * 3)]
    return docs, items


def _leaks(docs, items, width=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = _words(text)
        for i in range(max(len(w) - width + 1, 1) if w else 0):
            windows[tuple(w[i : i + width])].add(item)
    out = []
    for doc, text in docs:
        w, hit, found = _words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), _sha(",".join(ids)), bool(hit)))
    return sorted(out, key=_key)


@pytest.mark.parametrize("resident", [500_000, 0])
def test_decontamination_equals_brute_force(spark, monkeypatch, resident):
    monkeypatch.setattr(phrase_index, "RESIDENT", resident)
    docs, items = _leak_tables()
    d = spark.createDataFrame([(*r, 1, "x", "y", 2) for r in docs], "doc_id long, text string, row int, word string, w string, pos int").repartition(3)
    b = spark.createDataFrame([(*r, 1, "x", 3) for r in items], "item_id long, text string, win int, w string, item int")
    got = phrase_index.contamination(d, b)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = _leaks(docs, items)
    assert _rows(got) == expected and 10 < sum(r[-1] for r in expected) < len(docs)
    if resident:
        assert _rows(phrase_index.contamination(d, b, width=4)) == _leaks(docs, items, 4)
        assert not any(r.contaminated for r in phrase_index.contamination(d, b.limit(0)).collect())
        assert phrase_index.contamination(d.limit(0), b).count() == 0


def test_near_matches_equal_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate([1, 2, 3, 3, 4, 4, 5])] + [(9, "w1 w1")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=60))) for i in range(40)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    with Workspace(spark) as work:
        index = phrase_index.PhraseIndex(d, b, work)
        rows = index.near_matches(span=8).join(index.rows, "row").join(index.windows, "win")
        got = {(r.doc_id, tuple(r.terms), r.first, r.last) for r in rows.collect()}
        exact = index.matches().join(index.rows, "row").join(index.windows, "win").selectExpr("doc_id", "terms", "start")
        places = {(r.doc_id, tuple(r.terms), r.start) for r in exact.collect()}
    expected = set()
    for doc, text in docs:
        w = text.split()
        for _, item in items:
            terms = set(item.split())
            spans = [(j - i, i, j) for i in range(len(w)) for j in range(i, min(i + 8, len(w))) if terms <= set(w[i : j + 1])]
            if spans:
                expected.add((doc, tuple(item.split()), *min(spans)[1:]))
    assert got == expected and len(got) > 30
    assert places == {
        (doc, tuple(item.split()), i) for doc, text in docs for _, item in items for i in range(60)
        if text.split()[i : i + len(item.split())] == item.split()
    }


# --- conversation trie


def _xx(*values):
    """Spark's xxhash64: each hash is the seed of the next."""
    h = 42
    for v in values:
        data = v.to_bytes(4, "little", signed=True) if isinstance(v, int) else v.encode()
        h = xxhash.xxh64_intdigest(data, h)
    return h - (1 << 64) if h >> 63 else h


def _trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), _xx(role, text), _xx(1, text, role), (role, text)))
    own = {c: [t[-1] for t in sorted(ts)] for c, ts in own.items()}
    rebuilt = {}
    for c, ts in own.items():
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = collections.defaultdict(set)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].add(c)
    kids, out = collections.defaultdict(set), []
    for path in members:
        if path:
            kids[path[:-1]].add(path)
    for path, cs in members.items():
        under = [p for p in members if p[: len(path)] == path]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        ends = ",".join(map(str, sorted(c for c in cs if rebuilt[c] == path)))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids[path]),
                    sum(not kids[p] for p in under), saved, _sha(ends)))
    return sorted(out, key=_key)


def _conversations(seed):
    rng, rows = random.Random(seed), []
    roles, texts = ["user", "assistant", None], ["hi", "ok", "Grüße", "", None, "a longer answer"]
    for c in [*range(60), *range(-7, 0), *(10**12 + k for k in range(6))]:
        if c % 11 == 0:
            continue
        script = [(rng.choice(roles), rng.choice(texts)) for _ in range(12)] if c % 2 else [("user", "hi"), ("assistant", "ok")] * 5
        rows += [(c, t, *script[t % len(script)]) for t in range(rng.choice([1, 2, 3, 9, 12, 14]))]
    rows += [(70, t, "user", "hi") for t in (3, 1, None, 2, 2)] + [(70, 2, "user", "other"), (70, 3, "user", "hi"), (None, 0, "user", "hi")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [1000, 20])
def test_conversation_trie_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(conversation_trie, "HOT", hot)
    monkeypatch.setattr(conversation_trie, "BLOCK_BITS", 2 if hot == 20 else 14)
    rows = _conversations(hot)
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, depth int, s1 string")
    got = conversation_nodes(df.repartition(3))
    assert _rows(got) == _trie(rows)
    assert conversation_nodes(df.limit(0)).count() == 0


# --- manifest


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([_sha("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def _manifest(rows):
    """Expected rows; rows of equal ids and leaves may change places."""
    leaf = lambda d, t, lang, s, n: _sha("".join(map(_field, (d, s, lang, n, t))))
    groups = collections.defaultdict(list)
    for d, t, lang, s, n in rows:
        changed = t.replace("\n", "") if t and d is not None and zlib.crc32(str(d).encode()) % 2 == 0 else t
        groups[s].append((d, leaf(d, t, lang, s, n), leaf(d, changed, lang, s, n)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=_key)
        trees[s] = _levels([x[1] for x in groups[s]])
    top, out = _levels([trees[s][-1][0] for s in names]), []
    for k, s in enumerate(names):
        for i, (d, own, changed) in enumerate(groups[s]):
            steps = []
            for tree, at in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    first = at // 3 * 3
                    steps.append(("".join(level[first:at]), "".join(level[at + 1 : first + 3])))
                    at //= 3
            folded = changed
            for left, right in steps:
                folded = _sha(left + folded + right)
            root = top[-1][0]
            out.append((d, own, trees[s][-1][0], root, _sha("".join(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=_key)


def _documents(seed, sources):
    rng, rows = random.Random(seed), []
    for i in rng.sample(range(2000), 90):
        text = rng.choice(["a\nb", "plain", "Zeile\nzwei\n", "", None, "\n"])
        rows.append((i, text, rng.choice(["en", None]), rng.choice(sources), rng.choice([None, 5])))
    return rows + rows[:3] + [(None, "x\ny", "en", sources[0], 3), (rows[0][0], "other\n", "de", rows[0][3], 1)]


@pytest.mark.parametrize("sources,climb,resident", [
    (["s", "é", None, "Z", "alone"], 7, 20_000), (["s"] * 20 + [f"t{i}" for i in range(9)], 1, 0), (["one"], 2, 0), ([f"u{i}" for i in range(400)], 2, 0),
])
def test_manifest_equals_brute_force(spark, monkeypatch, sources, climb, resident):
    monkeypatch.setattr(merkle, "CLIMB", climb)
    monkeypatch.setattr(merkle, "RESIDENT", resident)
    rows = _documents(len(sources), sources)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, n int, path string, rank int")
    assert _rows(document_proofs(df.repartition(3))) == _manifest(rows)


def test_manifest_of_one_and_of_no_row(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    row = (4, "x\n", None, "s", 2)
    assert _rows(document_proofs(spark.createDataFrame([row], schema))) == _manifest([row])
    assert document_proofs(spark.createDataFrame([], schema)).count() == 0
