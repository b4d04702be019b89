"""Splits, mixing, overlap and capping on small fixtures, against brute force."""

import random
import time

import pytest

from weft.llm.capping import beyond_cap
from weft.llm.mixing import Mix, usable_clips
from weft.llm.overlap import CrossSplit, kinds, most_edits, segment_join
from weft.llm.splits import related_groups, solve_bundles, split_components, split_report

CLIP = "clip_id long, audio string, text string, source_id string, speaker string, speaker_verified boolean, session string, emotion string, duration double, dnsmos_overall double, split string, ingested_at timestamp"


def clips(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(clip_id=i + 1, audio=f"a{i}", text="t", source_id="s", speaker=None, speaker_verified=None, session=None, emotion=None, duration=1.0, dnsmos_overall=3.0, split="train", ingested_at=None)
        full.append(tuple((base | r).values()))
    return spark.createDataFrame(full, CLIP)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_cap_ties_nulls_and_placeholders(spark):
    rows = [dict(speaker="ns:A ", emotion="Happy", dnsmos_overall=s) for s in (4.0, None, 4.0, float("nan"), 5.0)]
    rows += [dict(speaker=s) for s in (None, " ", "ns:unknown", "NaN", "none")] * 3
    rows += [dict(speaker="NS:a", emotion=" happy ", dnsmos_overall=1.0)]
    got = {r[0] for r in beyond_cap(clips(spark, rows), cap=2).collect()}
    assert got == {2, 3, 4, 21}  # 5.0 first, then the smaller id of the equal scores
    assert beyond_cap(clips(spark, []), cap=2).count() == 0


def test_cap_against_sort(spark):
    r = random.Random(1)
    rows = [dict(speaker=f"n:{r.choice('abcc')}", emotion=r.choice(["x", None]), dnsmos_overall=r.choice([None, round(r.uniform(-1, 5), 1)])) for _ in range(400)]
    want = set()
    for key in {(x["speaker"], x["emotion"]) for x in rows}:
        own = [(-(x["dnsmos_overall"] if x["dnsmos_overall"] is not None else -99), i + 1) for i, x in enumerate(rows) if (x["speaker"], x["emotion"]) == key]
        want |= {i for _, i in sorted(own)[7:]}
    assert {x[0] for x in beyond_cap(clips(spark, rows), cap=7).collect()} == want


def test_groups_carry_on_and_need_verified(spark):
    rows = [dict(speaker="n:a", speaker_verified=True), dict(speaker="N:A", speaker_verified=True, session="x"), dict(session=" X"), dict(session="x", source_id="other"), dict(speaker="n:a", speaker_verified=False), dict(session="null"), dict(session="null")]
    assert {tuple(r) for r in related_groups(clips(spark, rows)).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert related_groups(clips(spark, [])).count() == 0


def test_split_keeps_groups_and_shares(spark):
    rows = [dict(session=f"e{i % 60}") for i in range(300)] + [dict() for _ in range(700)]
    src = spark.createDataFrame([("s", "tl")], "id string, lang string")
    goal = spark.createDataFrame([("tl", "train", 0.9), ("tl", "val", 0.05), ("tl", "test", 0.05)], "lang string, split string, share double")
    out = split_components(clips(spark, rows), src, goal).cache()
    assert out.count() == 1000
    assert out.groupBy("group_id").agg({"split": "approx_count_distinct"}).where("`approx_count_distinct(split)` > 1").count() == 0
    for r in split_report(out, goal).collect():
        assert abs(r["share"] - r["target"]) < 0.005


def test_bundles_use_all_components():
    dealt = solve_bundles([1, 7, 50], [100, 10, 1], [180.0, 20.0, 20.0])
    assert [sum(x) for x in dealt] == [100, 10, 1]
    assert dealt[2][0] == 1  # a component larger than a small split stays out of it


def test_mix_shares_caps_and_shortfall(spark):
    rows = [dict(source_id="big", duration=5.0) for _ in range(400)] + [dict(source_id="small", duration=5.0) for _ in range(20)]
    rows += [dict(source_id="big", audio="a0", duration=5.0), dict(source_id="big", duration=None), dict(source_id="big", duration=float("nan")), dict(source_id="big", split="val")]
    plan = spark.createDataFrame([("m", "big", 1.0, 3, None), ("m", "small", 1.0, 3, None), ("n", "big", 3.0, 2, 0.25), ("n", "small", 1.0, 2, 0.25), ("n", "none", 1.0, 2, 0.25)], "mix_name string, id string, weight double, max_repeat int, requested_train_hours double")
    c = clips(spark, rows)
    assert usable_clips(c).count() == 420
    mix = Mix(c, plan)
    rep = {(r["mix_name"], r["id"]): r for r in mix.report(spark.createDataFrame([("big", "tl")], "id string, lang string")).collect()}
    assert {k for k, r in rep.items() if r["short"]} == {("m", "small"), ("n", "none")}
    assert rep["m", "small"]["actual_seconds"] == 300 and rep["m", "small"]["most_uses"] == 3
    assert abs(rep["n", "big"]["actual_seconds"] - rep["n", "big"]["wanted_seconds"]) < 45
    uses = mix.records().groupBy("mix_name", "clip_id").count()
    assert uses.where("count > 3").count() == 0
    assert mix.records().count() == mix.records().distinct().count()


def test_segment_join_is_exact():
    r = random.Random(5)
    for trial in range(12):
        alphabet = "abc" if trial % 2 else "abcdefghij"
        base = ["".join(r.choice(alphabet) for _ in range(r.randint(20, 60))) for _ in range(5)]

        def change(s):
            s = list(s)
            for _ in range(r.randint(0, len(s) // 8)):
                i = r.randrange(len(s))
                s[i : i + r.randint(0, 1)] = r.choice(["", r.choice(alphabet)])
            return "".join(s)

        a = [x for x in (change(r.choice(base)) for _ in range(10)) if len(x) >= 20]
        b = [x for x in (change(r.choice(base)) for _ in range(20)) if len(x) >= 20]
        want = {(i, j, distance(x, y)) for i, x in enumerate(a) for j, y in enumerate(b) if 10 * distance(x, y) <= max(len(x), len(y))}
        assert set(segment_join(a, b)) == want
    assert segment_join([], ["x" * 30]) == []
    assert most_edits(20) == 2 and most_edits(90) == 10


def test_cross_split_pairs(spark):
    long = "the quick brown fox jumps over the lazy dog again and again"
    rows = [dict(text=long, split="val"), dict(text="(soft) " + long.upper() + "!!", split="train"), dict(text=long.replace("fox", "cat"), split="train"), dict(text="short", split="train"), dict(text="short", split="test"), dict(text=long, split=None), dict(text=None, split="train"), dict(text=long, split="train")]
    x = CrossSplit(clips(spark, rows))
    assert {tuple(r)[:3] for r in x.clip_pairs().collect()} == {(1, 2, 0), (1, 3, 3), (1, 8, 0)}
    r = x.report().collect()
    assert [(y["split"], y["held_clips"], y["pairs"], y["same_text_pairs"]) for y in r] == [("val", 1, 3, 2)]
    assert CrossSplit(clips(spark, [])).clip_pairs().count() == 0


@pytest.mark.parametrize("n", [20, 50, 137, 400])
def test_most_edits_covers_every_partner(n):
    assert all(max(n, m) // 10 <= most_edits(n) for m in range(n, 2 * n) if (m - n) * 10 <= m)


def _within(a: str, b: str) -> bool:
    """Whether the edits are few enough, by plain dynamic programming along the diagonal."""
    k = max(len(a), len(b)) // 10
    row = {j: j for j in range(min(k, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - k), min(len(b), i + k) + 1):
            new[j] = min(row.get(j, k + 1) + 1, new.get(j - 1, k + 1) + 1, row.get(j - 1, k + 1) + (x != b[j - 1])) if j else i
        row = new
    return row.get(len(b), k + 1) <= k


@pytest.mark.parametrize("size", [20, 21, 37, 64, 110, 240, 430])
def test_segment_join_keeps_pairs_at_the_limit(size):
    """Edits spread evenly, in clumps and at random, up to the last one allowed and one beyond."""
    rng = random.Random(size)
    held, train = [], []
    for _ in range(4):
        base = "".join(rng.choice("abcde") for _ in range(size))
        held.append(base)
        for how in range(5):
            for k in (most_edits(size), size // 10, size // 10 + 1):
                text = list(base)
                every = [size * (i + 1) // (k + 1) for i in range(k)]
                spots = [every, list(range(k)), list(range(size - k, size)), rng.sample(range(size), k), [min(size - 1, i // 2 * size // (k // 2 + 1) + i % 2) for i in range(k)]][how]
                for i in sorted(set(spots), reverse=True):
                    kind = rng.randrange(3)
                    text[i : i + 1] = [[], ["x"], [text[i], "y"]][kind]
                train.append("".join(text))
    train = [t for t in train if len(t) >= 20]
    wanted = {(i, j) for i, a in enumerate(held) for j, b in enumerate(train) if _within(a, b)}
    assert len(wanted) > 10
    assert {(i, j) for i, j, _ in segment_join(held, train)} == wanted


def test_stock_phrases_cost_no_more_than_other_texts():
    """Review r02, F1: pairs of texts put together from stock phrases were all looked at one by one."""
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    phrases = [[word(rng.randint(10, 16)) for _ in range(8)] for _ in range(4)]
    stock = ["".join(rng.choice(p) + word(6 if i == 3 else 0) for _ in range(4) for i, p in enumerate(phrases)) for _ in range(6000)]
    other = [word(len(t)) for t in stock]
    took = []
    for texts in (other, stock):
        texts = texts[:2000] + [texts[0][:90] + "x" + texts[0][95:], *texts[2000:]]
        start = time.process_time()
        assert (0, 0, distance(texts[0], texts[2000])) in segment_join(texts[:2000], texts[2000:])
        took.append(time.process_time() - start)
    assert took[1] < 4 * took[0] + 0.5


def test_near_texts_are_in_a_kind_the_other_may_have():
    rng = random.Random(5)
    pools = ["กขคงจฉชซ", "的一是不了人我在", "ăâđêôơưạảấ", "abcdefgh"]
    for _ in range(300):
        a, b = rng.sample(pools, 2)
        n = rng.randint(20, 90)
        share = rng.random()
        text = [rng.choice(a if rng.random() < share else b) for _ in range(n)]
        other = list(text)
        for i in rng.sample(range(n), most_edits(n)):
            other[i] = rng.choice(a)
        if _within("".join(text), "".join(other)):
            assert kinds(["".join(text)])[1][0] >> kinds(["".join(other)])[0][0] & 1


def test_bundles_end_within_a_record_of_the_quota():
    r = random.Random(4)
    for _ in range(30):
        sizes = sorted(r.sample(range(2, 60), 5)) + [1]
        counts = [r.randint(1, 8) for _ in range(5)] + [r.randint(150, 300)]
        total = sum(a * b for a, b in zip(sizes, counts))
        quotas = [0.9 * total, 0.05 * total, 0.05 * total]
        out = solve_bundles(sizes, counts, quotas)
        assert [sum(o) for o in out] == counts and min(map(min, out)) >= 0
        assert all(abs(sum(o[j] * s for o, s in zip(out, sizes)) - quotas[j]) <= 1 for j in range(3))


def test_share_cap(spark):
    rows = [dict(speaker="a", dnsmos_overall=float(i)) for i in range(8)] + [dict(speaker="b", dnsmos_overall=1.0), dict(speaker=None, dnsmos_overall=1.0)]
    assert [r[0] for r in beyond_cap(clips(spark, rows), share=0.3).orderBy("clip_id").collect()] == [1, 2, 3, 4, 5]
    assert beyond_cap(clips(spark, rows), cap=7, share=0.9).count() == 1 and beyond_cap(clips(spark, rows), share=0.0).count() == 7
    assert beyond_cap(clips(spark, []), share=0.5).count() == 0
