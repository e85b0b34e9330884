"""Small tables with nulls, empty and long texts, ties, repeats and clashing columns; brute force beside each operator."""

import collections
import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from rillweave.llm import cover_tree, line_dedup, ngram_join, packing, piece_codec, ppm, quality_rules, sharding, token_counts, token_files, wordhash
from rillweave.llm.common import BATCH_BYTES, Workspace, components, small_batches
from rillweave.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, w string, key long, n long"


def _texts(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Stop.", "été", "###", "$%", "(a)", "中文", "Áb"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 6, 60, 90]))) for _ in range(n)]
    base = rng.choices(vocabulary, k=120)
    for _ in range(15):  # near copies
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    lines = ["This line is on many pages.", "Another common line here."]
    texts += ["\n".join([rng.choice(lines), "a " * 30 + str(i), "x y z x y z"]) for i in range(12)]
    texts += [None, "", "   \n\t", "A B\n\nc\r\n\x0b\x0cd", texts[0], texts[0], "z" * 3000, "q r s " * 2000, "\x00odd ▁ mark", "<|endoftext|> J̌"]
    return texts


def _rows(texts):
    sources, langs = ["s0", "s0", "s1", None], ["en", "de", None]
    rows = [(i, t, langs[i % 3], sources[i % 4], len(t or ""), "r", "w", i, 1) for i, t in enumerate(texts)]
    return rows + [rows[5], (None, "lonely null id", "en", "s0", 1, "r", "w", 1, 1)]


@pytest.fixture(scope="module")
def rows():
    return _rows(_texts())


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _sorted(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 7)] + [(1000, 1000 + i) for i in range(1, 200)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    linked = {x for u, v in edges if u != v for x in (u, v)}
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_components_in_tasks_and_in_rounds(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(300)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(4)
    spark.sparkContext.setJobGroup("rounds", "")
    whole = _sorted(components(df, task_links=50), "node", "root")
    spark.sparkContext.setJobGroup("task", "")
    assert _sorted(components(df), "node", "root") == whole
    jobs = {g: len(spark.sparkContext.statusTracker().getJobIdsForGroup(g)) for g in ("rounds", "task")}
    spark.sparkContext.setJobGroup("", "")
    assert {r for n, r in whole if n >= 1000} == {1000}
    # A small graph takes no rounds, each of which is six shuffles.
    assert jobs["task"] <= 15 < jobs["rounds"]


def test_packing_equals_brute_force(spark, docs, rows, none):
    got = packing.pack(docs, capacity=500, group_rows=1000).collect()
    by_doc = collections.defaultdict(int)
    for r in got:
        by_doc[r.doc_id] += r.piece_length
    expected = collections.defaultdict(int)
    for r in rows:
        expected[r[0]] += len((r[1] or "").encode()) + 1
    assert by_doc == expected
    rng = random.Random(2)
    pieces = [(rng.randrange(1, 101), rng.randrange(6), rng.choice([-1, 0, 1, 2])) for _ in range(400)]
    pieces.sort(key=lambda p: -p[0])
    fit, bins = packing.BestFit(100), []
    for length, s, c in pieces:
        able = [
            (room, i) for i, (room, ss, cc) in enumerate(bins) if room >= length and s not in ss and (c < 0 or c not in cc)
        ]
        if able:
            i = min(able)[1]
        else:
            bins.append((100, set(), set()))
            i = len(bins) - 1
        bins[i] = (bins[i][0] - length, bins[i][1] | {s}, bins[i][2] | ({c} if c >= 0 else set()))
        assert fit.place(length, s, c) == i
    in_bin = collections.defaultdict(list)
    for r in got:
        in_bin[r.bin_id].append(r)
    for b in in_bin.values():
        b.sort(key=lambda r: r.bin_slot)
        assert [r.bin_slot for r in b] == list(range(len(b)))
        assert [r.bin_offset for r in b] == [sum(x.piece_length for x in b[:k]) for k in range(len(b))]
        assert sum(r.piece_length for r in b) <= 500 and len({r.source for r in b}) == len(b)
    assert packing.pack(none).count() == 0


def test_packing_parts_clusters(spark):
    rng, rows = random.Random(9), []
    for c in range(8):
        words = [f"v{rng.randrange(10**6)}" for _ in range(100)]
        one_off = [*words[:50], "changed", *words[51:]]
        for t in (" ".join(words), " ".join(one_off), "\t".join(words), "\r\n".join(words).upper(), "".join(words)):
            rows.append((None if c == 7 else len(rows), t, f"s{len(rows)}", c))
    cluster = {r[2]: r[3] for r in rows}
    bins = collections.defaultdict(list)
    for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string, c int")).collect():
        bins[r.bin_id].append(cluster[r.source])
    assert sum(map(len, bins.values())) == len(rows) and max(map(len, bins.values())) > 1
    assert all(len(set(b)) == len(b) for b in bins.values())


def test_packing_clusters_keep_letters_and_drop_blanks(spark):
    rows = [(0, "fox bob 0", "s0"), (1, "o o", "s1"), (2, "a\x0bc", "s2"), (3, "A\fC", "s3"), (4, "É\u2003é", "s4"), (5, "é\u2003\té", "s5")]
    bins = {r.doc_id: r.bin_id for r in packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert bins[0] == bins[1] and bins[2] != bins[3] and bins[4] != bins[5]
    named = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.cluster for r in packing.clusters(named, near_copies=False).collect()} == {
        r[0] for r in spark.sql("select explode(transform(array('foxbob0', 'oo', 'ac', 'é\u2003é'), x -> xxhash64(x)))").collect()
    }


def test_bitmaps_bound_long_texts_of_any_size(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(10**9)}" for _ in range(30_000)]
    texts = [words[:9000], words[9000:18_000], words[18_000:], words[100:9000], words[:700]]
    df = spark.createDataFrame([(i, i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text_hash long, text string")
    none = spark.sparkContext.broadcast((np.empty(0, np.uint64), np.empty(0, np.int64)))
    sets = ngram_join._sets(df, none, 5, 80)
    a, b = (sets.selectExpr(f"doc_id {x}", f"n n{x}", f"bitmap m{x}") for x in "ab")
    high = {(r.a, r.b): (r.na, r.nb, r.high) for r in a.join(b).selectExpr("a", "b", "na", "nb", f"{ngram_join._high('na', 'nb', 'ma', 'mb')} high").collect()}
    for (i, j), (na, nb, bound) in high.items():
        shared = len({tuple(texts[i][k : k + 5]) for k in range(na)} & {tuple(texts[j][k : k + 5]) for k in range(nb)})
        assert bound >= shared
    # Texts without a common n-gram are told apart without their whole sets, however long they are.
    assert all(100 * bound < 80 * (na + nb - bound) for (i, j), (na, nb, bound) in high.items() if {i, j} in ({0, 1}, {0, 2}, {1, 2}, {1, 3}))
    assert high[0, 3][2] * 100 >= 80 * (high[0, 3][0] + high[0, 3][1] - high[0, 3][2])


def test_cover_tree_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    vectors = [c + rng.normal(scale=s, size=8) for c in centres for s in rng.choice([0.01, 0.1, 0.2], 25)]
    rows = [(i, [float(x) for x in v], int(i % 3)) for i, v in enumerate(vectors)]
    rows += [(900, rows[0][1], 0), (901, [2 * x for x in rows[0][1]], 0), (902, None, 0), (903, [0.0] * 8, 0), (904, [float("nan")] * 8, 0)]
    rows += [(905, [1.0, None], 0), (906, rows[0][1], None), (907, [], 0), (908, [1.0], 0), (909, [float("inf")], 0)]
    usable = [(i, np.array(v), k) for i, v, k in rows if k is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, parent = collections.Counter(), {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a, ka in usable:
        for j, b, kb in usable:
            if i < j and ka == kb and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, point long")
    for cell in (4096, 20):  # one cell, and pivots with divided cells
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cover_tree.near_copies(df, cell_points=cell).collect()}
        assert got == {r[0]: (links[r[0]], find(r[0]), find(r[0]) == r[0]) for r in rows}
    assert cover_tree.near_copies(df.limit(0)).count() == 0


def test_cover_tree_takes_components_of_any_size(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    rows = [(100 * i + k, [float(x) for x in v * f]) for i, v in enumerate(base) for k, f in enumerate([1.0, 1e-200, 1e200])]
    rows += [(9000, [1e-200] * 8), (9001, [1e200] * 8), (9002, [1e308, -1e308] * 4), (9003, [5e-324, -5e-324] * 4)]
    unit = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    unit = {i: v / np.sqrt(v @ v) for i, v in unit.items()}
    links = {i: [j for j in unit if j != i and unit[i] @ unit[j] >= 0.98] for i in unit}
    assert set(links[9002]) == {9003} and set(links[9000]) == {9001}
    assert all(len(links[100 * i]) == 2 for i in range(40))  # so components are the three sizes of a vector
    expected = {i: (len(js), min([i, *js])) for i, js in links.items()}
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int")
    for cell in (4096, 16):
        got = {r.vec_id: (r.n_links, r.component_id) for r in cover_tree.near_copies(df, cell_points=cell).collect()}
        assert got == expected


def test_token_counts_equal_library(docs, rows, none):
    from tokenizers import models

    file = tokenizer_file("piece_bpe_32k.model")
    scores = token_counts.piece_scores(file)
    unigram = models.Unigram([("<unk>", 0.0), *scores.items()], 0, False)
    trie = token_counts.UnigramTrie(scores)
    words = {w for r in rows for w in (r[1] or "").encode().split() if len(w) < 200}
    trie.add(words)
    for w in words:
        if all(("▁" + w.decode())[k] in scores for k in range(len(w.decode()) + 1)):
            assert trie.terminals[w] == len(unigram.tokenize("▁" + w.decode())), w
    got = _sorted(token_counts.token_counts(docs, file), "doc_id", "n_words", "n_tokens")
    trie.add({w for r in rows for w in (r[1] or "").encode().split()})
    split = [(r[0], (r[1] or "").encode().split()) for r in rows]
    assert got == sorted(((i, len(w), sum(trie.terminals[x] for x in w)) for i, w in split), key=lambda r: (r[0] is not None, r))
    assert token_counts.token_counts(none, file).count() == 0


def test_sharding(docs, rows, none):
    got = sharding.shard_records(docs, shards=7, sample=64, fan=4).collect()
    sizes = collections.Counter()
    slots = collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r.size for r in got)
    assert max(sizes.values()) - sum(sizes.values()) / 7 <= largest
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    assert sharding.shard_records(none).count() == 0


def test_token_files_round_trip(spark, docs, rows, none):
    from tokenizers import Tokenizer

    file = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(file)
    with Workspace(spark) as work:
        got = token_files.round_trip(docs, file, 1, f"{work.path}/a").collect()
        assert token_files.round_trip(none, file, 1, f"{work.path}/b").count() == 0
    expected, start = [], 0
    encoded = [(i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t, *_ in rows]
    for i, ids in sorted(encoded, key=lambda r: (r[0] is not None, r[0])):
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected


def test_line_dedup(spark, docs, rows, none):
    got = line_dedup.line_dedup(docs, ratio=0.1, min_pages=2)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    pages = collections.defaultdict(set)
    for r in rows:
        if r[1] is not None:
            pages[r[3]].add(r[1])
    bad = set()
    for site, texts in pages.items():
        count = collections.Counter(x for t in texts for x in {y.strip(" \t\x0b\x0c\r") for y in t.split("\n")} if x)
        bad |= {(site, x) for x, n in count.items() if n >= 2 and n > 0.1 * len(texts)}
    assert bad
    expected = [
        (r[0], None if r[1] is None else "\n".join(x for x in r[1].split("\n") if (r[3], x.strip(" \t\x0b\x0c\r")) not in bad)) for r in rows
    ]
    assert _sorted(got, "doc_id", "text") == sorted(expected, key=lambda r: tuple((x is not None, x) for x in r))
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_keeps_near_copies(spark):
    rng = random.Random(8)
    prose = lambda: [" ".join(f"v{rng.randrange(10**6)}" for _ in range(12)) for _ in range(8)]
    base, footer, rows = prose(), "The same footer on each page.", []
    for i in range(60):
        lines = prose()
        if i < 6:  # one other word each, in another line each
            lines = list(base)
            lines[i] = lines[i].replace(lines[i].split()[3], f"changed{i}")
        rows.append((i, "\n".join([*lines, footer]), "s"))
    rows += [(100 + i, "\n".join(prose()), "t") for i in range(30)]
    got = line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert _sorted(got, "doc_id", "text") == [(i, t.replace("\n" + footer, "")) for i, t, _ in rows]


def test_piece_codec_equals_library(docs, rows, none):
    import sentencepiece

    file = tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=file)
    expected = []
    for i, t, *_ in rows:
        ids = library.encode(t or "") + [library.eos_id()]
        expected.append(
            (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        )
    got = piece_codec.piece_digests(docs, file)
    assert _sorted(got, *got.columns) == sorted(expected, key=lambda r: (r[0] is not None, r))
    assert piece_codec.encode_pieces(none, file).count() == 0


def test_piece_codec_on_random_pieces():
    import sentencepiece

    file = tokenizer_file("piece_bpe_32k.model")
    library, codec, rng = sentencepiece.SentencePieceProcessor(model_file=file), piece_codec.PieceCodec(file), random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices([*codec.piece[259:], " ", "\n", "\x00", "\x01", "▁"], k=rng.randrange(7)))
        ids = library.encode(text)
        assert codec.encode_text(text) == (" ".join(map(str, [*ids, 2])), library.decode([*ids, 2]))
        assert codec.decode([*ids, 2]) == library.decode([*ids, 2])


def _shingles(text):
    words = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_ngram_join_equals_brute_force(docs, rows, none):
    sets = [(r[0], _shingles(r[1])) for r in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    expected = [(d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets)]
    got = ngram_join.ngram_classes(docs)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert _sorted(got, "doc_id", "n_shingles", "component_id") == sorted(expected, key=key)
    kept = ngram_join.without_near_copies(docs)
    assert kept.columns == docs.columns
    assert _sorted(kept, "doc_id") == sorted(((d,) for d, _, c in expected if d == c), key=key)
    assert ngram_join.ngram_classes(none).count() == 0


def test_ngram_join_of_frequent_and_rare_lists(spark, docs, monkeypatch):
    sizes, first = [], _sorted(ngram_join.ngram_classes(docs), "doc_id", "text_hash", "component_id")
    entries = ngram_join._common_entries
    monkeypatch.setattr(ngram_join, "_common_entries", lambda *a: sizes.append(entries(*a).count()) or entries(a[0], lambda df, _: df, a[2]))
    # All lists in SQL, some in SQL and some packed, and those in several parts and buckets.
    for sample, frequent, part in ((1, 1, 1 << 26), (1, 4, 1 << 26), (2, 3, 500)):
        monkeypatch.setattr(ngram_join, "SAMPLE", sample)
        monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
        monkeypatch.setattr(ngram_join, "PART_NGRAMS", part)
        monkeypatch.setattr(ngram_join, "_BUCKET", part)
        assert _sorted(ngram_join.ngram_classes(docs), "doc_id", "text_hash", "component_id") == first
    assert len(sizes) == 3 and min(sizes) > 0


def test_packed_numbers_come_back(spark):
    rng = np.random.default_rng(6)
    tokens, n = rng.integers(-(2**63), 2**63 - 1, 5000), np.arange(5000)
    batch = ngram_join._dealt(tokens, 7, n)
    got = {b.as_py(): ngram_join._gathered(pa.table(batch.slice(k, 1)), 2) for k, b in enumerate(batch.column(0))}
    assert sorted(got) == list(range(7))
    assert all((t.view(np.uint64) % np.uint64(7) == b).all() and np.array_equal(tokens[x], t) for b, (t, x) in got.items())
    assert sum(len(t) for t, _ in got.values()) == 5000


def _ppm(strings, text, order):
    """Log10-probability by walking dictionaries."""
    total, history = 0.0, [0xFE] * order
    for symbol in [*text, 0xFF]:
        out, done = set(), False
        for k in range(order, -1, -1):
            seen = strings.get(tuple(history[len(history) - k :]))
            if not seen:
                continue
            left = {s: n for s, n in seen.items() if s not in out}
            if not left:
                continue
            weight = sum(left.values()) + len(left)
            total += math.log10((left.get(symbol) or len(left)) / weight)
            if symbol in left:
                done = True
                break
            out |= set(seen)
        if not done:
            total -= math.log10(255 - len(out))
        history = [*history, symbol]
    return total


def test_word_hashing_takes_little_memory():
    """A task's memory is bounded by the chunk, not by the batch; the sets do not depend on the chunks."""
    texts = pa.array([" ".join(f"w{(i * j) % 977}" for j in range(20_000)) for i in range(1, 60)])
    wordhash.words(np.zeros(1, np.uint8), np.array([0, 1]))  # what is kept between chunks
    tracemalloc.start()
    sets = [s for _, b, all_ in wordhash.shingle_sets(texts, 5) for s in np.split(all_, b[1:-1])]
    held = sum(s.nbytes for s in sets)
    peak = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert peak < 64 << 20
    assert all(np.array_equal(s, next(wordhash.shingle_sets(texts.slice(i, 1), 5))[2]) for i, s in enumerate(sets))


def test_batches_for_python_are_bounded(spark):
    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.nbytes])], names=["b"])

    long = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 5000) t")
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark):
        found = [r.b for r in long.mapInArrow(sizes, "b long").collect()]
    assert spark.conf.get(name) == before
    assert len(found) > 2 and max(found) < 2 * BATCH_BYTES


def test_ppm_equals_brute_force(docs, rows, none):
    plain = lambda t: " ".join(WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))).encode()
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    order, strings, words = 3, {}, collections.Counter()
    for r, out in zip(rows, held, strict=True):
        if not out:
            symbols = [0xFE] * order + [*plain(r[1]), 0xFF]
            words.update([*plain(r[1]).split(), None])
            for i in range(order, len(symbols)):
                for k in range(order + 1):
                    strings.setdefault(tuple(symbols[i - k : i]), collections.Counter())[symbols[i]] += 1
    n, v = sum(words.values()), len(words)
    expected = []
    for r, out in zip(rows, held, strict=True):
        tokens = [*plain(r[1]).split(), None]
        base = sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens)
        expected.append((r[0], out, len(tokens), sum(words[t] > 0 for t in tokens), n, base, _ppm(strings, plain(r[1]), order)))
    expected.sort(key=lambda r: (r[0] is not None, r))
    for options in ({}, {"block_rows": 300, "resident_words": 20}):
        got = _sorted(ppm.ppm_scores(docs, order=order, **options), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
        assert [g[:5] for g in got] == [e[:5] for e in expected]
        assert np.allclose([g[5:] for g in got], [e[5:] for e in expected], rtol=1e-9)
    assert ppm.ppm_scores(none).count() == 0


def test_quality_rules(spark, docs, rows, none):
    got = quality_rules.quality_verdicts(docs)
    expected = []
    for r in rows:
        text = r[1] or ""
        w = WORD.findall(text)
        count = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if count[x] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        expected.append(
            (r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
             len(w) < 50 or 100 * len(covered) > 50 * len(w))
        )
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert _sorted(got, *names) == sorted(expected, key=lambda r: (r[0] is not None, r))
    assert got.where("base_failed and kept").count() == 0
    kept = quality_rules.passing(docs)
    assert kept.columns == docs.columns
    assert _sorted(kept, "doc_id") == _sorted(got.where("kept"), "doc_id")
    assert quality_rules.quality_verdicts(none).count() == 0 and quality_rules.passing(none).count() == 0


def test_quality_rules_bound_a_cell_with_junk(spark):
    rng, rows = random.Random(7), []
    for i in range(200):
        junk = i < 40 and i % 10 < 3  # 30% of the cell s0
        text = " ".join(f"v{rng.randrange(10**6)}" + ("####" if junk else "") for _ in range(80))
        rows.append((i, text, "en" if i < 80 else "de", f"s{i // 40}", junk))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")
    policy = quality_rules.QualityPolicy(min_cell=20)
    clean = sorted(r[0] for r in rows if not r[4])
    assert [r[0] for r in _sorted(quality_rules.passing(docs, policy), "doc_id")] == clean
    assert [r[0] for r in _sorted(quality_rules.quality_verdicts(docs, policy).where("kept"), "doc_id")] == clean
    # A language of the cell alone cannot lift it either.
    alone = docs.selectExpr("doc_id", "text", "if(source = 's0', 'fr', lang) lang", "source", "junk")
    assert [r[0] for r in _sorted(quality_rules.passing(alone, policy), "doc_id")] == clean


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    plain = [r[:5] for r in _rows(_texts(n=30))]
    spark.createDataFrame(plain, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == ids
