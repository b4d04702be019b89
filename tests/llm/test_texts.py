"""Language, encoding, leakage, tokens, packing and quality on small fixtures."""

import random
import re
from array import array

import pytest

from weft.llm.encoding import Repairer, garbled_records, restore_text
from weft.llm.language import Identifier, SuffixAutomaton, label_language, language_cases
from weft.llm.leakage import WuManber, leaked_passages, passages
from weft.llm.letters import letters, words
from weft.llm.packing import Packing, plan_containers
from weft.llm.quality import Statistics, document_quality, induce_rules, text_statistics
from weft.llm.tokens import ChunkEncoder, encode_documents

REF = {
    "en": "The old sailor painted the paper lantern near the fish market because there was no bus left. My older cousin sold a basket of mangoes before the bell rang.",
    "tl": "Ang matandang mangingisda ay nagbenta ng isang basket na mangga sa tabi ng ilog dahil walang nagsabi sa amin. Sabi ng kapitbahay namin ay naglinis siya ng sapatos.",
    "id": "Tetangga kami sudah membicarakan surat lama di seberang sekolah minggu lalu karena listrik padam. Apakah benar penyanyi desa membawa sekotak lilin ke pantai.",
    "vi": "Ông lão đánh cá kể về quyển vở màu xanh trong thư viện vì đã hết xe buýt. Chúng tôi nghe cô giáo mới nói chuyện về cây chổi mới.",
    "th": "เมื่อวานตอนเช้ายามกลางคืนออกไปหากุญแจโกดังที่ชายหาด เราได้ยินพ่อครัวในห้องสมุดคุยกันเรื่องแว่นตา",
    "zh": "去年年底他的妻子在鱼市旁边等待着那把旧木椅，因为末班车已经开走。今天凌晨我们在沙滩上听见邮递员说起两张车票！",
}


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(REF.items())], "ref_id long, lang string, text string")


def clips(spark, rows):
    return spark.createDataFrame([(i + 1, t, lab, "train") for i, (t, lab) in enumerate(rows)], "clip_id long, text string, lang string, split string")


def test_automaton_counts_phrases():
    r = random.Random(2)
    text = "".join(r.choice("abc") for _ in range(60))
    m = SuffixAutomaton(text)
    for _ in range(100):
        s = "".join(r.choice("abcd") for _ in range(12))
        n, i = 0, 0
        while i < len(s):
            j = i + 1
            while j < len(s) and s[i : j + 1] in text:
                j += 1
            n, i = n + 1, j
        assert m.phrases(s) == n


def test_labels():
    assert [label_language(x) for x in ("Tagalog", "fil-PH", "zh_Hans", " th ", "in", "EN", "??", "", None)] == ["tl", "tl", "zh", "th", "id", "en", None, None, None]


def test_language_cases(spark, reference):
    rows = [
        ("The old sailor sold the paper lantern near the fish market.", "en-US"),
        ("The old sailor sold the paper lantern near the fish market.", "tl"),
        ("Ang mangingisda ay nagbenta ng isang basket na mangga sa tabi ng ilog.", None),
        ("Ang mangingisda ay nagbenta ng mangga sa tabi ng ilog. The old sailor painted the paper lantern near the market.", "tl"),
        ("去年年底他的妻子在鱼市旁边等待着那把旧木椅 เมื่อวานตอนเช้ายามกลางคืนออกไปหากุญแจ", "zh"),
        ("เมื่อวานตอนเช้า meeting ออกไปหากุญแจโกดังที่ชายหาด", "th"),
        (None, "xx"), ("   ", None), ("12345 !!", None),
        ("Ã´ng lÃ£o Ä\x91Ã¡nh cÃ¡ ká»\x83 vá»\x81 quyá»\x83n vá»\x9f mÃ u xanh", None),
    ]
    got = {tuple(r) for r in language_cases(clips(spark, rows), reference).collect()}
    assert got == {(2, "en"), (3, "tl"), (4, "tl"), (4, "en"), (5, "zh"), (5, "th")}
    assert language_cases(clips(spark, []), reference).count() == 0


def test_long_text_is_read_to_its_end():
    m = Identifier(REF)
    text = REF["tl"].lower() * 300 + " " + REF["en"].lower()
    assert {x[0] for x in m.identify(text)} == {"tl", "en"}


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "mac_roman", "cp437", "cp1251"])
def test_round_trip(wrong):
    fix = Repairer(REF)
    for text in (REF["th"], REF["vi"], REF["zh"]):
        try:
            bad = text.encode().decode(wrong)
        except UnicodeDecodeError:
            continue
        assert fix.repair(bad) == (True, text)
    once = "the niño sold it… for £6".encode().decode("cp1252")
    assert fix.repair(once.encode().decode("cp1252", "replace"))[0]


def test_clean_text_is_left_alone(spark, reference):
    fix = Repairer(REF)
    for text in [*REF.values(), "25°C at the café, ₱45 — «niño» 🙏🏽 ½ naïve", "a\xadb​c &amp; d", REF["vi"].upper(), "", "plain"]:
        assert fix.repair(text) == (False, text)
    rows = [("ni�o", None), ("seÃ±ora", None), (None, None), ("", None), (REF["th"], None)]
    assert {r[0] for r in garbled_records(clips(spark, rows), reference).collect()} == {1, 2}
    assert [r[2] for r in restore_text(clips(spark, rows), reference).orderBy("clip_id").collect()][1:4] == ["señora", None, ""]


def test_words_and_letters():
    assert words("Don’t — STOP_it… ① é") == words("don’t stop it 1 é") == "don t stop it 1 é"
    assert letters("(soft, slow) Ab-c 1!") == "abc1"


def test_wu_manber_against_search():
    r = random.Random(4)
    names = {"".join(r.choice("ab ") for _ in range(r.randint(6, 9))): frozenset([str(i)]) for i in range(30)}
    m = WuManber(names)
    for _ in range(50):
        t = "".join(r.choice("ab ") for _ in range(200))
        assert m.search(t) == {n for p, v in names.items() if p in t for n in v}
    assert WuManber({}).search("x") == set()


def test_leaks(spark, reference):
    held = spark.createDataFrame([("c1", "s1", "One two three four five six seven"), ("c2", "s1", "One two three four five six seven"), ("c3", "s2", "too short to leak"), ("c4", None, None)], "case_id string, source_sentence_id string, text string")
    rows = [("so ONE, two: three-four (five) six!", "en"), ("one two three four five sixty", "en"), ("one two three x four five six seven", "en"), (None, "en")]
    assert [tuple(r) for r in leaked_passages(clips(spark, rows), held, reference).collect()] == [(1, "s1")]
    assert passages([("a", "one two")]) == {}


def test_tokens_are_exact(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    enc = ChunkEncoder()
    texts = [*REF.values(), "don't  's" + " " * 40 + "x\n\n\ty\x85z\x1c\x1d", "<|endoftext|>", "'" * 50 + "ll", "👍🏽‍" * 40, " ".join(REF.values()) * 20, "a" * 5000]
    for text, want in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        for _ in range(2):
            out = array("i")
            enc.into(text, out)
            assert out.tolist() == want.ids
    df = spark.createDataFrame([(1, None), (2, ""), (3, "hi"), (3, "hi")], "doc_id long, text string")
    assert [r["ids"] for r in encode_documents(df).orderBy("doc_id").collect()] == [[], [], [5303], [5303]]


def test_plan_uses_every_item_once():
    r = random.Random(3)
    counts = {r.randint(1, 100): r.randint(1, 30) for _ in range(40)}
    rows, n = plan_containers(counts, 100)
    load = [0] * n
    for size, a, b, at, per in rows:
        for k in range(a, b):
            load[at + (k - a) // per] += size
    assert max(load) <= 100 and sum(load) == sum(k * v for k, v in counts.items())
    bins = []  # no worse than first fit decreasing
    for size in sorted((k for k, v in counts.items() for _ in range(v)), reverse=True):
        i = next((i for i, x in enumerate(bins) if x + size <= 100), None)
        if i is None:
            bins.append(size)
        else:
            bins[i] += size
    assert n <= len(bins)
    assert plan_containers({}, 10) == ([], 0)


def test_packing(spark):
    sizes = spark.createDataFrame([(1, 0), (2, 25), (3, 10), (4, 4), (5, 6), (6, 6), (6, 6)], "doc_id long, tokens long")
    caps = spark.createDataFrame([("p", "t", 10)], "pack_name string, tokenizer string, capacity long")
    p = Packing(sizes, caps)
    out = p.items.collect()
    assert len(out) == 9 and sum(r["size"] for r in out) == 57
    assert [r["container_id"] for r in out if r["doc_id"] == 1] == [None]
    assert sorted(r["size"] for r in out if r["doc_id"] == 2) == [5, 10, 10]
    load = {}
    for r in out:
        if r["container_id"] is not None:
            load[r["container_id"]] = load.get(r["container_id"], 0) + r["size"]
    assert max(load.values()) <= 10
    assert p.report(caps).first()["containers"] == len(load)
    assert Packing(sizes.where("false"), caps).items.count() == 0


def test_rules_find_a_threshold():
    np = pytest.importorskip("numpy")
    x = np.random.default_rng(1).random((400, 2))
    y = (x[:, 0] > 0.4).astype(int)
    rules = induce_rules(x, y, ("a", "b"))
    assert rules and rules[0][0][0] == "a" and rules[0][0][1] == "<=" and abs(rules[0][0][2] - 0.4) < 0.05


def test_quality_on_held_out_kinds(spark):
    d = "/root/testdata/sf0.001"
    prose = " ".join(r[0] for r in spark.read.parquet(f"{d}/lang_reference.parquet").where("lang = 'en'").orderBy("ref_id").select("text").limit(8).collect())
    rows = [(1, None), (2, ""), (3, " \n"), (4, prose), (5, "| a | b |\n|---|---|\n" + "| 1.5 | 22 |\n" * 20), (6, "so so " * 200), (7, "- a lantern\n- two mangoes\n- the bus\n" * 9), (8, prose * 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn
    docs = df("words", __import__("pyspark").sql.functions.lit(1))  # a clashing name is not read
    got = {r["doc_id"]: r["is_prose"] for r in document_quality(docs, spark.read.parquet(f"{d}/lang_reference.parquet"), spark.read.parquet(f"{d}/common_words.parquet")).collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 5, 6, 7)} == {1: None, 2: None, 3: None, 4: 1, 5: 0, 6: 0, 7: 0}
    assert re.match(r"\d", str(got[8]))


def test_right_text_in_other_scripts_stays():
    fix = Repairer(REF)
    for text in (
        "Вчера вечером мы долго гуляли по набережной и говорили о старых книгах.", "Москва, 12 мая. Совет города одобрил новый маршрут трамвая.", "Він сказав, що її сестра приїде у п'ятницю.",
        "Χθες το βράδυ περπατήσαμε στην παραλία.", "ذهبنا إلى السوق في الصباح الباكر.", "कल शाम हम नदी के किनारे टहलने गए थे।", "어제 저녁에 우리는 강가를 걸었다.", "昨日の夜、私たちは海岸を散歩しました。",
    ):
        assert fix.repair(text) == (False, text)
        if text[0] in "ВМ":
            for codec in ("cp1252", "cp1251", "koi8_r"):
                bad = text.encode().decode(codec, "replace") if codec == "koi8_r" else "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in text.encode())
                assert fix.repair(bad)[0], (codec, bad)


@pytest.mark.parametrize("lang", ["th", "zh", "vi"])
def test_text_read_as_latin_twice_comes_back(lang):
    twice = REF[lang].encode().decode("latin-1").encode().decode("latin-1")
    assert Repairer(REF).repair(twice) == (True, REF[lang])


def test_every_chain_of_readings_is_followed():
    class Table(Repairer):
        """Readings and lengths from a table instead of codecs."""

        steps = {"é": ["b", "c", "d", "longer"], "d": ["best of third"], "longer": ["right"]}
        sizes = {"é": 200, "b": 100, "c": 110, "d": 120, "longer": 300, "best of third": 60, "right": 40}
        suspicious = staticmethod(lambda t: True)
        _multi = _legacy = staticmethod(lambda t: iter(()))

        def _single(self, t):
            return iter(self.steps.get(t, ()))

        def length(self, t):
            return self.sizes[t]

    assert Table(REF).repair("é") == (True, "right")  # gains only at the second step
    Table.sizes = {**Table.sizes, "right": 400}
    assert Table(REF).repair("é") == (True, "best of third")  # by a first step that ranks third


def test_statistics_count_every_symbol(spark):
    import unicodedata

    texts = ["@#$%", "a@b#c ^^ {x}=<y>", "“Oh”—he said… 5%", "你好，世界！１２", "x٣ ½ don't well-known", "\u00a0 \n", "rhythmst a1 plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = text_statistics(docs, spark.createDataFrame([], "lang string, word string")).orderBy("doc_id").collect()
    for t, r in zip(texts, got):
        kinds = [unicodedata.category(c)[0] for c in t]
        assert r["symbol_share"] == pytest.approx(sum(k in "PS" for k in kinds) / len(t), abs=1e-6), t
        assert r["digit_share"] == pytest.approx(kinds.count("N") / len(t), abs=1e-6), t
    assert [r["words"] for r in got] == [0, 5, 4, 5, 4, 0, 3]  # a Han character is a word
    assert [r["odd_share"] for r in got][-1] == pytest.approx(2 / 3, abs=1e-6)


def test_rules_hold_on_texts_not_made_by_the_generator(spark):
    from natural_texts import JUNK, PROSE

    d = "/root/testdata/sf0.001"
    texts = [t for v in PROSE.values() for t in v] + JUNK
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = document_quality(docs, spark.read.parquet(f"{d}/lang_reference.parquet"), spark.read.parquet(f"{d}/common_words.parquet")).orderBy("doc_id").collect()
    prose = [r["is_prose"] for r in got][: -len(JUNK)]
    junk = [r["is_prose"] for r in got][-len(JUNK) :]
    assert sum(prose) >= 0.9 * len(prose) and junk.count(0) >= 0.9 * len(junk)


def test_statistics_do_not_depend_on_the_other_texts():
    from natural_texts import JUNK, PROSE

    texts = [t for v in PROSE.values() for t in v] + JUNK + ["", " \n", "\n\n", "a", "เ", "字", "x " * 3000, "\u200b"]
    make = Statistics(["the", "and", "yang", "của", "ที่", "的", "我们"])
    together = make.of(texts)
    for i, t in enumerate(texts):
        assert {k: v[0] for k, v in make.of([t]).items()} == {k: v[i] for k, v in together.items()}, t
    assert together["repeat_share"][-2] > 0.99 and together["words"][-3] == 1 and together["chars"][-1] == 0
    one = make.of(["the cat and the dog"])
    assert (one["words"][0], one["common_share"][0], one["mean_word"][0]) == (5, 0.6, 3.0)
    assert make.of(["我们的书"])["common_share"][0] == pytest.approx(0.5)


def test_too_many_common_words_are_an_error(spark, reference):
    from pyspark.sql import functions as F

    many = spark.range(20_001).select(F.lit("en").alias("lang"), F.concat(F.lit("w"), F.col("id")).alias("word"))
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    with pytest.raises(ValueError, match="20000"):
        text_statistics(docs, many)
    with pytest.raises(ValueError, match="20000"):
        language_cases(clips(spark, [("hello there my friend", "en")]), reference, many)


def test_empty_tables(spark, reference):
    none = reference.where("false")
    docs = spark.createDataFrame([(1, "- a\n- b"), (2, None)], "doc_id long, text string")
    words_ = spark.createDataFrame([], "lang string, word string")
    assert [r["is_prose"] for r in document_quality(docs, none, words_).orderBy("doc_id").collect()] == [1, None]
    assert document_quality(docs.where("false"), reference, words_).count() == 0
    rows = clips(spark, [("hello there my friend", "xx"), ("ni\ufffdo", "en")])
    assert language_cases(rows, none).count() == 0
    assert [r[0] for r in garbled_records(rows, none).collect()] == [2]
    assert leaked_passages(rows, spark.createDataFrame([], "case_id string, source_sentence_id string, text string"), none).count() == 0
    assert encode_documents(docs.where("false")).count() == 0
    sizes = spark.createDataFrame([(1, 5)], "doc_id long, tokens long")
    assert Packing(sizes, spark.createDataFrame([], "pack_name string, tokenizer string, capacity long")).items.count() == 0


def test_clashing_columns_are_not_read(spark, reference):
    from pyspark.sql import functions as F

    from weft.llm.capping import beyond_cap
    from weft.llm.overlap import CrossSplit

    rows = clips(spark, [("The old sailor sold the paper lantern near the fish market.", "tl")] * 2)
    for name in ("id", "who", "what", "hi", "h", "q", "letters", "band", "h1", "label", "garbled", "n", "count"):
        rows = rows.withColumn(name, F.lit("x"))
    rows = rows.withColumn("speaker", F.lit("a")).withColumn("emotion", F.lit(None).cast("string")).withColumn("dnsmos_overall", F.lit(None).cast("double")).withColumn("source_id", F.lit("s"))
    assert language_cases(rows, reference).count() == 2
    assert [r[0] for r in beyond_cap(rows, cap=1).collect()] == [2]
    assert CrossSplit(rows).clip_pairs().count() == 0
