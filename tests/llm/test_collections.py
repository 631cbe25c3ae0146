import random

import numpy as np
import pytest

from capstrata.llm import neardup, packing, spans
from capstrata.llm.common import attach_group, pair_rows


def test_attach_group_joins_hot_and_cold(spark):
    rows = spark.createDataFrame([(i, i % 7 if i % 2 else 0) for i in range(300)], "id bigint, k int")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "n")
    got = attach_group(rows, groups.where("k <> 3"), ["k"]).collect()
    assert len(got) == rows.where("k <> 3").count() and all(r.n for r in got)


def test_pair_rows_over_blocks(spark):
    rows = spark.createDataFrame([(i, 1, 200, str(i % 3)) for i in range(200)], "id bigint, k int, n bigint, t string")
    assert pair_rows(rows, ["k"], "id").count() == 200 * 199 // 2
    assert pair_rows(rows, ["k"], "id", other="t").count() == sum(a % 3 != b % 3 for a in range(200) for b in range(a))


def jaccard(a, b):
    return len(a & b) / len(a | b)


def near_texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(3))
    out = []
    for _ in range(120):
        base = ["a", "boat", "near", "the"] + [word() for _ in range(10)]
        out.append(" ".join(base))
        for _ in range(rng.randrange(0, 4)):
            other = list(base)
            for _ in range(rng.randrange(1, 4)):
                kind = rng.randrange(3)
                at = rng.randrange(len(other))
                if kind == 0:
                    other[at] = word()
                elif kind == 1:
                    other.insert(at, word())
                else:
                    other[at], other[0] = other[0], other[at]
            out.append(" ".join(other))
    return out + out[:5] + [None, "", "too few words", " ".join(out[0].upper().split()[::-1])]


def test_near_captions_against_brute_force(spark):
    texts = near_texts()
    rows = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "pair_id bigint, caption string, n string").repartition(3)
    sets = [neardup.words_of(t) if t else set() for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if min(len(sets[i]), len(sets[j])) >= 8 and jaccard(sets[i], sets[j]) >= 0.7}
    got = [(r.id_a, r.id_b) for r in neardup.near_captions(rows).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.98 * len(want)
    left = {(r.id_a, r.id_b) for r in neardup.near_captions(rows, leave_out=lambda ids: ids.where("id % 5 = 0")).collect()}
    assert left == {p for p in got if p[0] % 5 and p[1] % 5}
    assert neardup.near_captions(rows.limit(0)).count() == 0


def test_first_darts_fall_by_weight():
    rng = np.random.default_rng(1)
    count = rng.choice([2, 5, 40], 30)
    common = np.arange(30) < 12  # words of both of two records; the first dart of all is theirs as often as their weight is
    words = rng.integers(0, 2**63, (20_000, 30)).astype(np.uint64)
    first = neardup.first_darts(words, count).argmin(1)
    assert common[first].mean() == pytest.approx((1 / count[common]).sum() / (1 / count).sum(), abs=0.015)


def test_close_hashes_under_dense_keys(monkeypatch):
    rng = np.random.default_rng(2)
    value = rng.integers(0, 2**63, 40).astype(np.uint64).repeat(6) ^ (np.uint64(1) << rng.integers(0, 64, 240).astype(np.uint64))
    want = {(i, j) for j in range(240) for i in range(j) if int(value[i] ^ value[j]).bit_count() <= 5}
    for dense in (1_000, 50):
        monkeypatch.setattr(neardup, "DENSE", dense)
        a, b = neardup._close(np.zeros(240, np.uint64), value, 5)
        assert {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist())} == want
    assert all(len(neardup.hash_masks(n, 5)) == k for n, k in ((1000, 21), (10**8, 126)))


def test_large_classes_are_spread(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SALT_ROWS", 7)
    members = spark.createDataFrame([(1, i, 40) for i in range(40)] + [(2, 100 + i, 3) for i in range(3)], "rep bigint, id bigint, n bigint")
    links = spark.createDataFrame([(2, 1)], "rep_a bigint, rep_b bigint")
    got = [tuple(r) for r in neardup._sided(links, members).collect()]
    assert len(got) == 120 and set(got) == {(i, 100 + j) for i in range(40) for j in range(3)}


def test_near_hashes_are_lossless(spark):
    rng = random.Random(8)
    hashes = []
    for _ in range(60):
        h = rng.getrandbits(64)
        hashes.append(h)
        for _ in range(3):
            x = h
            for bit in rng.sample(range(64), rng.randrange(0, 8)):
                x ^= 1 << bit
            hashes.append(x)
    rows = spark.createDataFrame([(i, f"{h:016x}") for i, h in enumerate(hashes)] + [(900, None), (901, "zz"), (902, f"{hashes[0]:016x}")], "image_id bigint, phash string")
    full = dict(enumerate(hashes)) | {902: hashes[0]}
    want = {(i, j) for j in full for i in full if i < j and (full[i] ^ full[j]).bit_count() <= 5}
    got = [(r.id_a, r.id_b) for r in neardup.near_hashes(rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert neardup.near_hashes(rows.limit(0)).count() == 0


def test_packing(spark):
    rng = random.Random(2)
    sizes = [rng.choice([0, 3, 100, 2048, 2049, 5000, *[rng.randrange(1, 900) for _ in range(12)]]) for _ in range(400)] + [None]
    items = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)] + [(0, sizes[0])], "id bigint, size bigint")
    got = packing.pack(items, block_items=150).collect()
    fill, per = {}, {}
    for r in got:
        fill[r.container] = fill.get(r.container, 0) + r.size
        per.setdefault(r.id, []).append(r)
    assert max(fill.values()) <= 2048 and set(per) == set(range(401))
    assert sum(r.size for r in got) == sum(s or 0 for s in sizes) + (sizes[0] or 0)
    assert all(len(per[i]) == (1 if (s or 0) <= 2048 else -(-s // 2048)) for i, s in enumerate(sizes) if i)
    assert len(fill) <= 1.04 * sum(fill.values()) / 2048 + 6
    assert {(r.id, r.part, r.container) for r in packing.pack(items, block_items=150).collect()} == {(r.id, r.part, r.container) for r in got}
    assert packing.pack(items.limit(0)).count() == 0


def planted(rng, bins, capacity):
    """Sizes of items that fill so many containers of three items each to the last place."""
    out = []
    for _ in range(bins):
        a = rng.randrange(capacity // 4, capacity // 2)
        b = rng.randrange(capacity // 4, capacity - a - capacity // 8)
        out += [a, b, capacity - a - b]
    rng.shuffle(out)
    return out


def test_evolution_beats_best_fit_where_there_is_room():
    rng = random.Random(5)
    better = 0
    for seed in range(4):
        sizes = planted(rng, 80, 2048)
        order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
        plain = len(packing.best_fit(sizes, order, [], 2048))
        evolved = packing.evolve(sizes, 2048, seed)[0]
        assert sorted(i for b in evolved for i in b) == list(range(240)) and all(sum(sizes[i] for i in b) <= 2048 for b in evolved)
        assert 80 <= len(evolved) <= plain
        better += len(evolved) < plain
        print(plain, len(evolved))
    assert better >= 3


def shared_texts():
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefghij klmnopé京") for _ in range(n))
    passages = [text(n) for n in (160, 161, 159, 200, 400, 150)]
    out = [text(rng.randrange(0, 900)) for _ in range(60)]
    for i in range(0, 60, 3):
        p = passages[i % len(passages)]
        for j in (i, i + 1):
            at = rng.randrange(len(out[j]) + 1)
            out[j] = out[j][:at] + p + out[j][at:]
    return out + ["=" * 3000, "x" + "=" * 500, None, "", out[0], "ab" * 400, "ba" * 300]


def test_spans_against_brute_force(spark):
    texts = shared_texts()
    grams = [{t[i : i + 160] for i in range(len(t) - 159)} if t else set() for t in texts]
    want = {(i, j) for j in range(len(texts)) for i in range(j) if grams[i] & grams[j]}
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, start int").repartition(4)
    got = [(r.id_a, r.id_b) for r in spans.shared_spans(rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    share = {r.doc_id: r for r in spans.shared_share(rows).collect()}
    assert len(share) == len(texts) and all(0 <= r.share <= 1 for r in share.values()) and share[0].share > 0.9 and share[62].share == 0.0
    assert spans.shared_spans(rows.limit(0)).count() == 0 and spans.shared_share(rows.limit(0)).count() == 0


def pairs_by_force(texts):
    sets = [neardup.words_of(t) for t in texts]
    return {(i, j) for j in range(len(texts)) for i in range(j) if jaccard(sets[i], sets[j]) >= 0.7}


def test_near_captions_that_differ_in_rare_words(spark):
    rng = random.Random(8)
    common = [f"common{i}" for i in range(200)]
    texts = [" ".join(rng.sample(common, 10)) for _ in range(900)]
    for k in range(60):  # ten common words and a rare word each; 16 common words, and one rare shared, two different
        base = rng.sample(common, 10)
        texts += [" ".join([*base, f"rare{k}x{i}"]) for i in range(2)]
        base = [*rng.sample(common, 16), f"both{k}"]
        texts += [" ".join([*base, f"own{k}x{i}", f"other{k}x{i}"]) for i in range(2)]
    for k in range(40):  # a template that fills a part of the rows, and longer texts of unlike sizes
        texts.append("a photo of the old {} in a small town by the river seen from above".format(" ".join(f"t{k}{c}" for c in "abc"[: k % 4])))
        base = rng.sample(common, 60)
        texts += [" ".join(base), " ".join(base[: rng.randrange(38, 46)])]
    rows = spark.createDataFrame(list(enumerate(texts)), "pair_id bigint, caption string").repartition(3)
    got = [(r.id_a, r.id_b) for r in neardup.near_captions(rows).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs_by_force(texts)


def test_prefix_keys_of_hot_words(monkeypatch):
    monkeypatch.setattr(neardup, "SALT_ROWS", 7, raising=False)
    words = [neardup.hash_words({f"w{j}" for j in range(10)} | {f"own{i}"}) for i in range(30)]
    sizes, flat, ids = np.array([len(w) for w in words]), np.concatenate(words), np.arange(30)
    counts = np.bincount((flat >> np.uint64(64 - neardup.DF_BITS)).astype(np.int64), minlength=1 << neardup.DF_BITS)
    met = [{}, {}]
    for larger in (False, True):
        for doc, key in zip(*neardup.prefix_keys(ids, sizes, flat, counts, 0.7, larger)):
            met[larger].setdefault(key, set()).add(doc)
    assert {(a, b) for key, left in met[0].items() for a in left for b in met[1].get(key, ())} == {(a, b) for a in range(30) for b in range(30)}


def test_shared_share_against_brute_force(spark):
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghij klmnopé京") for _ in range(n))
    runs = [text(n) for n in (100, 120, 140, 159, 165, 170, 200, 400)]
    texts = [text(rng.randrange(20, 300)) + runs[i % 8] + text(rng.randrange(20, 300)) for i in range(64)]
    texts += [text(50) + "|".join([runs[7]] * 5) + text(50), runs[7]]
    grams = [{t[i : i + 160] for i in range(len(t) - 159)} for t in texts]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r.shared_chars for r in spans.shared_share(rows).collect()}
    for k, t in enumerate(texts):
        others = set().union(*(g for j, g in enumerate(grams) if j != k))
        marked = set()
        for i in range(len(t) - 159):
            if t[i : i + 160] in others:
                marked.update(range(i, i + 160))
        assert got[k] == len(marked), k


def test_every_run_holds_a_whole_chunk():
    rng = np.random.default_rng(3)
    texts, size = [], 160
    while len(texts) < 400:  # runs whose least hash stands in the middle, where either neighbour may be decided outside
        run = rng.integers(97, 123, (4000, size)).astype(np.uint32)
        order = spans.cut_points(run.ravel(), np.arange(len(run)) * size, 1)[0].reshape(run.shape)
        for context in (spans.CONTEXT,):
            h = np.zeros((len(run), size - context + 1), np.uint64)
            for back in range(context):
                h += order[:, context - 1 - back : size - back] << np.uint64(back)
            h ^= h >> np.uint64(29)
            texts += ["".join(map(chr, r)) for r in run[h.argmin(1) == (size - context) // 2]]
    around = lambda: "".join(map(chr, rng.integers(97, 123, 200)))
    pairs = [around() + t + around() for t in texts for _ in range(2)]
    ids, hi, lo, _, _ = spans.chunk_rows(np.arange(len(pairs)), pairs, spans.window_for(size))
    found = {}
    for i, key in zip(ids.tolist(), zip(hi.tolist(), lo.tolist())):
        found.setdefault(i, set()).add(key)
    assert all(found[2 * k] & found[2 * k + 1] for k in range(len(texts)))


def test_word_counts_in_any_number_of_parts(spark):
    texts = [t for t in near_texts() if t]
    sets = neardup.caption_sets(spark.createDataFrame(list(enumerate(texts)), "id bigint, text string"), "id", "text")
    held = [w for t in texts if len(words := neardup.words_of(t)) >= neardup.MIN_WORDS for w in words]
    slot, n = np.unique(neardup.hash_words(held) >> np.uint64(64 - neardup.DF_BITS), return_counts=True)
    for parts in (8, 9, 33):
        table = neardup.word_counts(sets, parts).load()
        assert len(table) == 1 << neardup.DF_BITS and np.count_nonzero(table) == len(slot)
        assert (table[slot.astype(np.int64)] == np.searchsorted(neardup._ABOUT, n)).all()
