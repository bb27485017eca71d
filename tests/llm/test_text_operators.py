"""The text operators against brute force on a small table of odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from starload.llm import bpe, decontam, language, licenses, minhash, packing, paragraphs, quality, suffixes
from starload.llm.components import connected_components
from starload.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_quality(spark, edge_docs, edge_rows, no_docs):
    good = spark.createDataFrame([(10,), (11,), (20,), (None,), (999,)], "id long")
    got = collections.Counter(tuple(r) for r in quality.quality(edge_docs, good).select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect())
    want = collections.Counter()
    for i, t in edge_rows:
        w, covered, seen, dup = words(t), set(), set(), 0
        three = collections.Counter(zip(w, w[1:], w[2:]))
        for k in range(len(w) - 2):
            if three[tuple(w[k : k + 3])] > 1:
                covered |= {k, k + 1, k + 2}
        for line in (t or "").split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want[(i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered), failed)] += 1
    assert got == want
    assert quality.quality(no_docs, good).count() == 0


def test_quality_score_is_the_mean_log_ratio(spark, edge_docs, edge_rows):
    import math

    import xxhash

    def signed(x):
        return x - (1 << 64) if x >= 1 << 63 else x

    def grams(text):
        h = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words(text)]
        pair = lambda a, b: signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little", signed=True), xxhash.xxh64_intdigest(a.to_bytes(8, "little", signed=True), 42)))
        return [x % quality.BUCKETS for x in h] + [pair(a, b) % quality.BUCKETS for a, b in zip(h, h[1:])]

    good = {10, 20}
    every, trusted = np.ones(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for i, t in edge_rows:
        for g in grams(t):
            every[g] += 1
            trusted[g] += i in good
    share = every / every.sum()
    ratio = np.log((trusted + quality.PRIOR * share) / (trusted.sum() + quality.PRIOR) / share)
    got = collections.defaultdict(list)
    for r in quality.quality(edge_docs, spark.createDataFrame([(x,) for x in good], "id long")).collect():
        got[r.id].append(r.score)
    for i, t in edge_rows:
        g = grams(t)
        assert any(s is None if not g else s is not None and math.isclose(s, ratio[g].mean(), abs_tol=1e-9) for s in got[i]), i


def test_token_counts(edge_docs, edge_rows, no_docs):
    t = tokenizer()
    got = collections.Counter(tuple(r) for r in bpe.token_counts(edge_docs, tokenizer_path()).collect())
    want = collections.Counter()
    for i, text in edge_rows:
        n = len(t.encode(text or "", add_special_tokens=False).ids)
        want[(i, len((text or "").encode()), n, n > 1024)] += 1
    assert got == want
    assert bpe.token_counts(no_docs, tokenizer_path()).count() == 0


def test_merging_order():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("ab", "c"): 2, ("a", "bc"): 3, ("a", "a"): 4}
    assert bpe.merged_length(list("abc"), ranks) == 1  # bc first, then a + bc
    assert bpe.merged_length(list("aaaaa"), ranks) == 3  # pairs from the left
    assert bpe.merged_length([], ranks) == 0 and bpe.merged_length(["x"], ranks) == 1


def test_token_counts_of_random_strings():
    import random

    rng, t, c, e = random.Random(3), tokenizer(), bpe.counter(tokenizer_path()), packing.encoder(tokenizer_path(), 1)
    parts = [" ", "  ", "\n", "\t", "the", "'s", "'", "é", "1", "23", "#", "$$$", " ", "​", "<|endoftext|>", "<|endof", "你", "😀", "\x1c", "\x85", "\r", "²", "_", "\x00"]
    for _ in range(2000):
        s = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        ids = t.encode(s, add_special_tokens=False).ids
        assert c.count(s) == len(ids) and list(e.ids(s)) == [*ids, 1], repr(s)


def shingles(text, k):
    w = lower(text).encode().split()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(edge_docs, edge_rows, no_docs, k):
    sets = [shingles(t, k) for _, t in edge_rows]
    group = list(range(len(sets)))
    for x, s in enumerate(sets):
        for y, r in enumerate(sets):
            if s and r and group[x] != group[y] and 100 * len(s & r) >= 80 * len(s | r):
                group = [group[x] if g == group[y] else g for g in group]
    low = {g: min((edge_rows[x][0] for x in range(len(sets)) if group[x] == g and edge_rows[x][0] is not None), default=None) for g in group}
    want = collections.Counter((i, len(s), low[g] if s else i) for (i, _), s, g in zip(edge_rows, sets, group, strict=True))
    got = minhash.near_duplicates(edge_docs, shingle=k).select("id", "n_shingles", "component_id")
    assert collections.Counter(map(tuple, got.collect())) == want
    assert minhash.near_duplicates(no_docs).count() == 0


def test_near_duplicates_refuses_what_it_can_not_promise(edge_docs):
    with pytest.raises(ValueError, match="80"):
        minhash.near_duplicates(edge_docs, percent=79)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (95, 100), (7, 7), (None, 3)] + [(1000, 1001 + i) for i in range(50)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90} | {1000 + i: 1000 for i in range(51)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeats(rows, n):
    """Words of each document that lie in runs of n words that an earlier one has (by id, rows with an id only)."""
    first, out = {}, collections.defaultdict(set)
    for i, t in sorted((r for r in rows if r[0] is not None and r[1]), key=lambda r: r[0]):
        w = t.encode().split()
        for k in range(len(w) - n + 1):
            if first.setdefault(tuple(w[k : k + n]), i) != i:
                out[i] |= set(range(k, k + n))
    return out


def test_repeated_passages(edge_docs, edge_rows, no_docs):
    found, want = collections.defaultdict(set), repeats(edge_rows, 50)
    for r in paragraphs.repeated_passages(edge_docs).collect():
        assert r.first_id < r.id and r.cluster_id <= r.first_id
        found[r.id] |= set(range(r.start, r.end))
    near = {12: 300}  # a near copy is found beyond its equal words
    assert {i: len(found[i]) for i in near} == near
    assert {21, 22, 11, 12, 13} <= set(want) and all(want[i] <= found[i] for i in want)
    assert set(found) <= set(want)
    assert paragraphs.repeated_passages(no_docs).count() == 0


def test_passages_that_a_document_repeats(spark):
    import random

    from prose import prose

    rng, rows = random.Random(11), []
    for i in range(12):  # an earlier document has the passage once or twice, a later one two to six times
        shared = prose(rng, (60, 80, 100, 300)[i % 4], 10**6)
        for copies in (1 + i % 2, 2 + i % 5):
            parts = [prose(rng, rng.randint(20, 60), 10**6) + shared for _ in range(copies)]
            rows.append((len(rows), " ".join(sum(parts, []) + prose(rng, 30, 10**6))))
    x, y, z = (prose(rng, 40, 10**6) for _ in range(3))  # one phrase in two contexts: the later document has the second one
    rows += [(len(rows), " ".join(y + x + y + z + x + z)), (len(rows) + 1, " ".join(prose(rng, 50, 10**6) + z + x + z))]
    line = prose(rng, 30, 10**6)
    rows += [(len(rows), " ".join(line * 40)), (len(rows) + 1, " ".join(line * 90 + prose(rng, 40, 10**6) + line * 3))]
    found, want = collections.defaultdict(set), repeats(rows, 50)
    for r in paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        found[r.id] |= set(range(r.start, r.end))
    assert {i: len(want[i] - found[i]) for i in want if want[i] - found[i]} == {}
    assert set(found) <= set(want)


def test_texts_move_for_long_runs_only(spark, monkeypatch):
    import random

    from prose import prose

    rng = random.Random(23)
    phrase, passage, other = prose(rng, 12, 10**6), prose(rng, 70, 10**6), prose(rng, 70, 10**6)
    rows = [(i, " ".join(prose(rng, 40, 10**6) + phrase + prose(rng, 40, 10**6))) for i in range(30)]
    rows += [(i, " ".join(prose(rng, 30, 10**6) + passage + prose(rng, 30, 10**6))) for i in (30, 31)]
    head = prose(rng, 30, 10**6)  # an id with two texts that have the passage at one place, and different words before it
    rows += [(32, " ".join(head + other)), (32, " ".join(head[:20] + prose(rng, 10, 10**6) + other[:60])), (33, " ".join(head[5:] + other)), (34, " ".join(prose(rng, 9, 10**6) + other))]
    moved, matched = [], paragraphs.matched
    monkeypatch.setattr(paragraphs, "matched", lambda pairs, *a: (moved.append({(r.a, r.b) for r in pairs.select("a", "b").collect()}), matched(pairs, *a))[1])
    found, want = collections.defaultdict(set), repeats(rows, 50)
    for r in paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        found[r.id] |= set(range(r.start, r.end))
    assert {31, 33, 34} <= set(found) and all(want[i] <= found[i] for i in (31, 33, 34))
    assert moved[0] <= {(30, 31), (32, 33), (33, 34)} and (30, 31) in moved[0]  # no two texts that share the phrase alone


def test_edited_passages(spark):
    """Pairs of documents that share an edited passage: how much of it is found, by brute force knowledge of where it lies."""
    import random

    from prose import prose

    rng, rows, where = random.Random(17), [], {}
    word = lambda: prose(rng, 1, 10**6)

    def edited(p, changes, kind):
        p, n = p.copy(), len(p)
        for c in range(changes, 0, -1):
            at = c * n // (changes + 1)
            p[at : at + 1] = {"replace": word(), "insert": [p[at], *word()], "delete": []}[kind]
        return p

    cases = [(50, 0, "replace"), (60, 0, "replace"), (80, 1, "replace"), (80, 1, "insert"), (80, 1, "delete"), (120, 2, "replace"), (200, 3, "replace"), (200, 3, "insert")]
    for case in cases:
        for _ in range(25):
            passage = prose(rng, case[0], 10**6)
            rows.append((len(rows), " ".join(prose(rng, 100, 10**6) + passage + prose(rng, 100, 10**6))))
            copy = edited(passage, *case[1:])
            where[len(rows)] = (case, 100, 100 + len(copy))
            rows.append((len(rows), " ".join(prose(rng, 100, 10**6) + copy + prose(rng, 100, 10**6))))
    rows += [(5000 + i, " ".join(prose(rng, 45, 10**6))) for i in range(3)]
    half = prose(rng, 100, 10**6)  # too many differences: every tenth word
    rows += [(6000, " ".join(half)), (6001, " ".join(w if i % 10 else "x" for i, w in enumerate(half)))]
    found, texts = collections.defaultdict(set), dict(rows)
    for r in paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect():
        found[r.id] |= set(range(r.start, r.end))
        x, y = texts[r.first_id].split()[r.first_start : r.first_end], texts[r.id].split()[r.start : r.end]
        u, v = (set(zip(*[w[k:] for k in range(5)])) for w in (x, y))
        assert min(len(x), len(y)) >= 50 and 100 * len(u & v) >= 80 * len(u | v)
        assert r.cluster_id == r.first_id == r.id - 1
    for case in cases:
        shares = [len(found[i] & set(range(a, b))) / (b - a) for i, (c, a, b) in where.items() if c == case]
        assert sum(shares) / len(shares) >= 0.9, (case, sum(shares) / len(shares))
    assert all(i in where and len(found[i] - set(range(*where[i][1:]))) <= 5 for i in found)


def test_clusters_of_passages(spark):
    """A passage that goes from 3 to 2 to 1 with other neighbours is one cluster; another one stands for itself."""
    import random

    from prose import prose

    rng = random.Random(19)
    a, b, c = (prose(rng, 60, 10**6) for _ in range(3))
    rows = [(1, a), (2, a + b[:10]), (3, b[10:] + a), (4, b[10:] + c[:5]), (8, c), (9, prose(rng, 30, 10**6) + c)]
    got = {r.id: r.cluster_id for r in paragraphs.repeated_passages(spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")).collect()}
    assert {got[i] for i in (2, 3)} == {1} and got[9] == 8


def test_duplicate_spans(edge_docs, edge_rows, no_docs):
    found, want = collections.defaultdict(set), repeats(edge_rows, 50)
    texts = dict(edge_rows)
    for r in suffixes.duplicate_spans(edge_docs).collect():
        mine, other = texts[r.id].split()[r.start : r.end], texts[r.other_id].split()[r.other_start : r.other_start + r.end - r.start]
        assert len(mine) >= 50 and mine == other
        if r.repeat:
            found[r.id] |= set(range(r.start, r.end))
    assert dict(found) == dict(want)
    assert suffixes.duplicate_spans(no_docs).count() == 0


def test_spans_around_a_common_phrase(spark):
    import random

    from prose import prose

    rng, rows = random.Random(13), []
    for longer in (50, 50, 52, 55, 60, 50, 51, 53):  # sixty documents have a phrase, two of them share a longer passage around it
        phrase = prose(rng, 45, 10**6)
        left = rng.randint(0, longer - 45)
        passage = prose(rng, left, 10**6) + phrase + prose(rng, longer - 45 - left, 10**6)
        for i in rng.sample(range(60), 60):
            rows.append((len(rows), " ".join(prose(rng, 40, 10**6) + (passage if i < 2 else phrase) + prose(rng, 40, 10**6))))
    found, want = collections.defaultdict(set), repeats(rows, 50)
    for r in suffixes.duplicate_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("repeat").collect():
        found[r.id] |= set(range(r.start, r.end))
    assert len(want) == 8 and dict(found) == dict(want)


def test_contamination(spark, edge_docs, edge_rows, no_docs):
    texts = dict(edge_rows)
    items = [(1, " ".join(texts[20].split()[5:30])), (2, "ONE"), (2, "ONE"), (3, None), (4, ""), (None, " ".join(texts[40].split()[100:112])), (5, "same line"), (10, texts[10][:400]), (6, "nothing of this kind"), (7, "x" * 50000)]
    item = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = collections.Counter()
    for i, t in edge_rows:
        w, hit, names = item.findall(lower(t)), set(), set()
        for name, x in items:
            v = item.findall(lower(x))
            n = min(10, len(v))
            runs = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in runs:
                    hit |= set(range(k, k + n))
                    names |= {str(name)} if name is not None else set()
        want[(i, len(w), len(hit), tuple(sorted(names)))] += 1
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(edge_docs, table).drop("text_hash").collect()
    assert collections.Counter((r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in got) == want
    assert decontam.contamination(no_docs, table).count() == 0
    assert decontam.contamination(edge_docs, table.limit(0)).where("n_hit > 0").count() == 0


@pytest.mark.parametrize("fan_in", [1000, 2])
def test_packing(spark, edge_docs, edge_rows, no_docs, fan_in, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    t = tokenizer()
    ids = collections.defaultdict(list)
    for i, text in edge_rows:
        ids[i].append(np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4"))
    rows = packing.pack(edge_docs.repartition(5), tokenizer_path(), length=256, n_open=4).collect()
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    total = sum(len(x) for xs in ids.values() for x in xs)
    assert sum(r.length for r in rows) == total and len(sequences) <= total / 256 * 1.1 + 1
    for i, xs in ids.items():
        left = collections.Counter()
        for r in rows:
            if r.id == i:
                assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in xs)
                left[r.doc_tokens] += r.length
        assert left == collections.Counter({n: n * c for n, c in collections.Counter(map(len, xs)).items()})
    assert packing.pack(no_docs, tokenizer_path()).count() == 0


def test_language(spark, no_docs):
    import random

    rng, rows = random.Random(5), []
    parts = {"en": ["the", "ing", "tion", "wh", "and "], "de": ["ung", "sch", "ein", "der ", "lich"], "fr": ["eau", "oir", "que ", "è", "ment"]}
    for i in range(300):
        lang = "en de fr".split()[i % 3]
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(1, 60)))
        said = lang if i % 10 else "en"  # a tenth is declared wrongly or not at all
        rows.append((i, text, None if i % 20 == 0 else said, f"h{i % 3}.example.{'de' if lang == 'de' else 'com'}"))
    rows += [(900, None, "en", "h"), (901, "", None, None), (902, "12 34 ##", "en", ""), (903, "жйф цщэ юыё", "en", "h0.example.com"), (None, rows[0][1], "en", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, declared string, site string").withColumnRenamed("site", "host").repartition(3)
    from pyspark.sql import functions as F

    host = F.col("host")
    got = {r.id: r for r in language.identify(docs, declared=F.col("declared"), host=host, domain=F.substring_index(host, ".", -2), suffix=F.substring_index(host, ".", -1)).collect()}
    assert len(got) == len(rows)
    assert sum(got[i].lang == "en de fr".split()[i % 3] and got[i].accepted for i in range(300)) >= 297
    assert not any(got[i].accepted for i in (900, 901, 902, 903)) and got[None].accepted
    assert language.identify(no_docs, declared=F.col("lang"), host=F.col("source")).count() == 0


def test_languages_of_few_documents(spark):
    import random

    from pyspark.sql import functions as F

    rng, rows = random.Random(8), []
    for i in range(1200):
        lang = "en de".split()[i % 2]
        parts = ["the", "ing", "tion", "wh", "and "] if lang == "en" else ["ung", "sch", "ein", "der ", "lich"]
        rows.append((i, " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(30)), lang))
    russian = ["ный ", "ост", "ени", "про", "ать "]
    rows += [(2000 + i, " ".join("".join(rng.choices(russian, k=2)) for _ in range(80)), "en" if i == 4 else "ru") for i in range(5)]
    rows += [(2100, "这是一个很短的句子", "zh"), (2101, "mikä tämä kieli oikein on", "fi"), (2102, "ko wai tenei reo", "mri"), (2103, "texto em outra língua", "pt-BR")]
    rows += [(2200, rows[0][1], "unknown"), (2201, rows[0][1], "und"), (2202, "123", "fi"), (2203, rows[1][1], None), (2204, "жйф цщэ юыё", "?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r.id: r for r in language.identify(docs, declared=F.col("lang")).collect()}
    assert len(got) == len(rows) and all(got[i].accepted and got[i].lang == rows[i][2] for i in range(1200))
    assert all(got[2000 + i].accepted and got[2000 + i].lang == "ru" and got[2000 + i].posterior > 0.5 for i in range(5))
    assert [(got[i].lang, got[i].accepted) for i in range(2100, 2104)] == [(x, True) for x in ("zh", "fi", "mri", "pt")]
    assert [got[i].posterior is None for i in range(2100, 2104)] == [False, False, True, False]
    assert [(got[i].lang, got[i].accepted) for i in (2200, 2201, 2203)] == [("en", True), ("en", True), ("de", True)]
    assert not got[2202].accepted and not got[2204].accepted


def test_a_language_does_not_depend_on_its_neighbours(spark):
    """Ten Russian texts that say so, one that says nothing and one that says English, beside few and many English ones."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(9)
    russian = ["ный ", "ост", "ени", "про", "ать ", "ска", "ово"]
    few = [(i, " ".join("".join(rng.choices(russian, k=2)) for _ in range(40)), "ru" if i < 10 else None if i == 10 else "en") for i in range(12)]
    for n in (100, 5000):
        english = [(100 + i, " ".join("".join(rng.choices(["the", "ing", "tion", "wh", "and "], k=rng.randint(1, 3))) for _ in range(20)), "en") for i in range(n)]
        got = language.identify(spark.createDataFrame(few + english, "doc_id long, text string, lang string").repartition(3), declared=F.col("lang")).collect()
        assert len(got) == n + 12 and all(r.accepted and r.lang == ("ru" if r.id < 12 else "en") for r in got)


def test_address_and_markup(spark):
    from pyspark.sql import functions as F

    rows = [("https://u:p@WWW.A.example.org:80/x?y#z", '<!x><HTML class="k" lang=\'de-AT\'><script>if (a<b) {}</script><p>Text</p>'), ("no address", "plain"), (None, None)]
    df = spark.createDataFrame(rows, "url string, html string")
    got = df.select(*language.address_parts(F.col("url")), language.markup_language(F.col("html")), F.trim(language.visible_text(F.col("html")))).collect()
    assert [tuple(r) for r in got] == [("www.a.example.org", "example.org", "org", "de", "Text"), (None, None, None, None, "plain"), (None,) * 5]


def test_licences(spark):
    rows = [
        (1, "r/a/x.py", "code\nLicensed under the Apache License, Version 2.0.\nmore code of some kind"), (2, "r/a/b/y.py", "plain text"), (3, "r/z.py", ""), (4, "r/LICENSE", "Released under the MIT License."),
        (5, "r/a/b/COPYING", "words\nThis work is licensed under the GNU General Public License, version 3."), (6, "q/v.py", None), (7, None, "Released under the MIT License."), (8, "top.txt", "text"),
        (9, "r/a/b/c/d/e.txt", "the license of this is unknown"), (None, "r/k.txt", "x"), (10, "q/w/notice", "a very long line " * 50 + "Released under the MIT License."), (11, "s/f", "Licensed under CC BY-NC 4.0."), (12, "s/g/h", "x"), (12, "s/g/h", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(3)
    got = collections.Counter((r.id, r.licence, r.origin, r.licence_path) for r in licenses.scan(docs, "doc_id", "path", "text").collect())
    assert got == collections.Counter([
        (1, "Apache-2.0", "own", "r/a/x.py"), (2, "GPL-3.0", "inherited", "r/a/b/COPYING"), (3, "MIT", "inherited", "r/LICENSE"), (4, "MIT", "own", "r/LICENSE"), (5, "GPL-3.0", "own", "r/a/b/COPYING"),
        (6, None, "none", None), (7, "MIT", "own", None), (8, None, "none", None), (9, "GPL-3.0", "inherited", "r/a/b/COPYING"), (None, "MIT", "inherited", "r/LICENSE"), (10, None, "none", None),
        (11, "CC-BY-NC-4.0", "own", "s/f"), (12, "CC-BY-NC-4.0", "inherited", "s/f"), (12, "CC-BY-NC-4.0", "inherited", "s/f"),
    ])
    assert licenses.scan(docs.limit(0), "doc_id", "path", "text").count() == 0


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_crowded_buckets_do_not_compare_all_pairs(spark, monkeypatch):
    import random

    from starload.llm import minhash

    r, docs, made = random.Random(3), [], []
    for k in range(120):
        words = [f"b{i}" for i in range(300)]
        for at in r.sample(range(300), 22):
            words[at] = f"own{k}x{at}"
        docs.append(words)
    docs += [[*docs[5][:-1], "other"], [*docs[90][:-2], "last", "two"]]
    write = minhash.materialize

    def seen(df, name):
        out = write(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(minhash, "materialize", seen)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    got = {x.id: x.component_id for x in minhash.near_duplicates(df, shingle=2).collect()}
    sets = [set(zip(w, w[1:])) for w in docs]
    near = {i: next(j for j in range(i + 1) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])) for i in range(len(docs))}
    assert got == near and near[120] == 5 and near[121] == 90
    assert made[-1] < 10 * len(docs)


def test_crowded_buckets_move_sketches_once_a_node(spark, monkeypatch):
    from starload.llm import minhash

    docs, kept = [], {}
    for k in range(60):  # every bucket that a phrase of 300 words makes is crowded, and its members stay apart
        words = [f"b{i}" for i in range(300)]
        for at in range(k, 300, 13):
            words[at] = f"own{k}x{at}"
        docs.append((k, " ".join(words)))
    write = minhash.materialize
    monkeypatch.setattr(minhash, "materialize", lambda df, name: kept.setdefault(name, []).append(df.columns) or write(df, name))
    minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), shingle=2).count()
    assert kept["dealt"] == [["key", "node", "component"]]
    assert not {"sig", "bits"} & {c for columns in kept["apart"] for c in columns}


def test_texts_hashed_together(monkeypatch):
    import random

    import numpy as np

    from starload.llm import common

    r = random.Random(5)
    texts = [None, b"", b" \n ", b"one", b"  a\tb\x0b ", b"x" * 200, *[b" ".join(b"%d" % r.randrange(9) for _ in range(r.randrange(60))) for _ in range(50)], b""]
    alone = [common.word_hashes(t or b"") for t in texts]
    for stretch in (64, 1 << 16):
        monkeypatch.setattr(common, "STRETCH", stretch)
        groups = list(common.hashed_together(texts))
        assert [i for index, _, _ in groups for i in index] == list(range(len(texts)))
        got = [h[start:end] for _, h, bounds in groups for start, end in zip(bounds, bounds[1:], strict=False)]
        assert all(np.array_equal(x, y) for x, y in zip(got, alone, strict=True))
    assert len(groups) == 1


def test_a_text_of_many_pairs_is_hashed_once(spark, monkeypatch):
    from starload.llm import passages

    hashed = []
    real = passages.hashed_together
    monkeypatch.setattr(passages, "hashed_together", lambda texts: hashed.append(len(texts)) or real(texts))
    monkeypatch.setattr(passages, "materialize", lambda df, name: df)
    docs = spark.createDataFrame([(k, f"t{k} same words") for k in range(1, 9)], "id long, text string").selectExpr("id", "cast(text as binary) text")
    pairs = spark.createDataFrame([(a, 1, b, 1) for a in range(1, 9) for b in range(1, 9) if a < b], "a long, pa long, b long, pb long").coalesce(1)
    runs = {}
    monkeypatch.setattr(type(pairs), "mapInArrow", lambda df, f, schema: runs.update(f=f, rows=df))
    passages.matched(pairs, docs, lambda x, y, seeds: [(0, len(x), 0, len(y), *seeds[0])])
    table = runs["rows"].coalesce(1).toArrow().combine_chunks()
    out = [r for b in runs["f"](table.to_batches()) for r in b.to_pylist()]
    assert len(out) == 28 and hashed == [8] and all(r["end_a"] == r["end_b"] == 3 for r in out)
