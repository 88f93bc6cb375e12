"""Each text operator against a plain version, on fixtures with nulls, empty and long texts, ties and repeated rows."""
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartwise.llm import (chat_format, decontaminate, exact_dedup, language, ngram_join, packing, quality, queries,
                           secrets, suffix_dedup, toxicity)
from chartwise.llm.common import read
from chartwise.llm.suffix_groups import suffix_order

from ..conftest import SF_SMALL
from . import brute

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, key string, n bigint"


def frame(spark, pairs, schema=DOCS):
    """Rows of (doc_id, text) with the other columns of documents and some whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 0, None, None) for i, t in pairs], schema)


def some_texts(seed=0, n=60):
    """Copies, near copies, shared passages, null, empty, short and very long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = " ".join(words(45))
    texts = [None, "", " \n\t", "one", "Two WORDS", "two words", "x" * 5000]
    base = words(120)
    for k in range(n):
        w = words(rng.randint(2, 90))
        if k % 5 == 0:
            w = list(base)
            for _ in range(k % 7):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if k % 4 == 1:
            w += [passage]
        t = " ".join(w)
        texts += [t] if k % 6 else [t, t.upper(), t]
    texts.append(" ".join(words(6000)))
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def texts():
    return some_texts()


def got(df, columns, key="doc_id"):
    return {r[key]: tuple(r[c] for c in columns) for r in df.collect()}


def test_ngram_join_matches_all_pairs(spark, texts):
    out = ngram_join.ngram_components(frame(spark, texts))
    assert got(out, ["n_shingles", "component_id"]) == brute.jaccard_components(texts, 4, 85)


def test_ngram_join_in_large_trees_and_tiles(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 2)
    monkeypatch.setattr(ngram_join, "FEW", 0)
    monkeypatch.setattr(ngram_join, "TILE", 4)
    monkeypatch.setattr(ngram_join, "SCOUTS", 2)
    out = ngram_join.ngram_components(frame(spark, texts), percent=80, words=5)
    assert got(out, ["n_shingles", "component_id"]) == brute.jaccard_components(texts, 5, 80)


def core_group(tails, seed):
    """Documents of one core of 340 words, each with its own tail of so many words."""
    rng = random.Random(seed)
    core = " ".join(f"c{k}" for k in range(340))
    return [(i, " ".join([core, *(f"t{i}x{k}x{rng.randrange(9)}" for k in range(n))])) for i, n in enumerate(tails)]


def test_ngram_join_keeps_the_links_of_a_document_with_a_long_tail_beside_a_hot_core(spark):
    """Half of the smallest hashes of the last document lie in a tail of its own: it meets the core in hot trees only."""
    docs = core_group([0 if k % 2 else 6 for k in range(80)], 1)
    rng = random.Random(2)
    import pyarrow as pa

    core = docs[1][1]
    for trial in range(100_000):
        tail = " ".join(f"w{trial}x{k}" for k in range(58))
        sets = next(ngram_join.shingle_sets(pa.array([f"{core} {tail}"]), 4))
        own = np.setdiff1d(sets, next(ngram_join.shingle_sets(pa.array([core]), 4)))
        if np.isin(sets[:24], own).sum() >= 9:
            break
    docs.append((500, f"{core} {tail}"))
    docs += [(600 + k, " ".join(f"o{k}x{rng.randrange(10 ** 6)}" for _ in range(50))) for k in range(20)]
    assert got(ngram_join.ngram_components(frame(spark, docs)), ["n_shingles", "component_id"]) == brute.jaccard_components(docs, 4, 85)


def test_ngram_join_of_a_large_group_with_the_default_constants(spark):
    """250 different holders of a core, some near it and some not, two cores that share a passage."""
    docs = core_group([(k * 7) % 90 for k in range(250)], 3)
    docs += [(1000 + i, t.replace("c1", "d1").replace("c2", "d2")) for i, t in docs[:40]]
    assert got(ngram_join.ngram_components(frame(spark, docs)), ["n_shingles", "component_id"]) == brute.jaccard_components(docs, 4, 85)


def test_count_tree_never_loses_a_pair():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 400, rng.integers(1, 200)) for _ in range(300)]
    sets += [np.append(s[: len(s) - len(s) // 12], [900]) for s in sets[:100]]
    sets = [np.unique(s) for s in sets]
    n = np.array([len(s) for s in sets])
    counts = np.array([np.bincount(s % ngram_join.GROUPS, minlength=ngram_join.GROUPS) for s in sets], np.int32)
    tree = ngram_join.CountTree(n, counts)
    for a in range(len(sets)):
        near = set(tree.near(int(n[a]), counts[a], 85).tolist())
        for b in range(len(sets)):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 85 * (n[a] + n[b] - both):
                assert b in near


def test_exact_dedup(spark, texts):
    out = exact_dedup.exact_dedup(frame(spark, texts))
    assert got(out, ["keep_id", "group_size", "kept", "text_sha256"]) == brute.exact_groups(texts)


def test_exact_dedup_prefix_and_repeated_rows(spark):
    rows = [(1, "A" * 300 + "x"), (2, "a" * 300 + "y"), (3, "É"), (4, "é"), (5, "a" * 300 + "X"), (5, "a" * 300 + "X")]
    out = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(frame(spark, rows)).collect()}
    assert out == {(1, 5, 3, False), (2, 2, 1, True), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 3, True)}
    assert sorted(r.doc_id for r in exact_dedup.keep_last_copies(frame(spark, rows)).collect()) == [2, 3, 4, 5, 5]


ITEMS = [(0, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (1, "Short item, three!"),
         (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda"), (3, None), (4, "..."), (5, "short item three"),
         (None, "quite another item of words that goes on for some more words here")]


def contaminated():
    return [(1, "x Alpha-beta gamma delta epsilon zeta eta theta iota kappa lambda mu y"), (2, "a short item three b"),
            (3, "alpha beta gamma delta epsilon zeta eta theta iota"), (4, None), (5, ""), (6, "short item, four"),
            (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa alpha beta gamma delta epsilon zeta eta theta iota kappa"),
            (8, "quite another item of words that goes on for some more words here " * 3 + "clean " * 90)]


@pytest.mark.parametrize("shard_words", [decontaminate.SHARD_WORDS, 20])
def test_decontaminate(spark, shard_words):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontaminate.find_contamination(frame(spark, contaminated()), items, shard_words=shard_words)
    out = got(decontaminate.contamination_digests(found), ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert out == brute.contamination(contaminated(), ITEMS)


def test_decontaminate_with_long_and_repeated_items(spark):
    many = [(0, " ".join(f"w{k % 97}x{k}" for k in range(300))), (0, "another text under the id of the first one, which repeats it"), (0, None)]
    many += [(7, f"seventh item number {k} has some words of its own here and there {k}") for k in range(30)] * 2
    docs = [(1, " ".join(f"w{k % 97}x{k}" for k in range(40, 260)) + " tail"), (2, many[1][1]), (2, many[1][1]), (None, many[9][1]),
            (3, " ".join(f"w{k % 97}x{k}" for k in [*range(100, 109), *range(200, 211)]))]
    items = spark.createDataFrame(many, "item_id bigint, text string")
    cut = decontaminate.shards(items, "item_id", "text", 10, 120)
    sizes = [sum(len(r.text.split()) for r in part.collect()) for part in cut]
    assert len(cut) > 3 and max(sizes) <= 120
    found = decontaminate.find_contamination(frame(spark, docs), items, shard_words=120)
    out = decontaminate.contamination_digests(found).collect()
    want = brute.contamination([(k, t) for k, (_, t) in enumerate(docs)], many)
    cols = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((repr(r.doc_id), *[r[c] for c in cols]) for r in out) == sorted((repr(docs[k][0]), *v) for k, v in want.items())


def test_decontaminate_removes_spans(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = frame(spark, contaminated())
    out = decontaminate.remove_contamination(docs, items)
    assert out.columns == docs.columns
    left = {r.doc_id: r for r in out.collect()}
    assert sorted(left) == [3, 4, 5, 6, 8]                       # mostly contaminated ones go
    assert left[3].text == dict(contaminated())[3] and left[4].text is None
    assert "quite" not in left[8].text and left[8].n_chars == len(left[8].text)
    assert not any(v[4] for v in brute.contamination([(8, left[8].text)], ITEMS).values())


def test_decontaminate_on_supplied_tables(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, SF_SMALL, "benchmark").collect()]
    out = got(queries.op6_decontaminate(spark, SF_SMALL), ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    assert out == brute.contamination(docs, items)


def test_secrets(spark):
    rows = [(0, None), (1, ""), (2, "Password: hunter22, tOKEN='ab.c+d=/'"), (3, "api_key=short token=token: abcdefgh"),
            (4, "AKIA" + "A1" * 9 + " AKIA123"), (5, "é" * 9 + "deadbeef" * 4 + "g" + "ab" * 11), (6, "secret = 'abc'"),
            (7, "passwÅord=abcdef ſecret=abcdefg"), (8, "x" * 20000 + " apikey:QWERTYUIOP"),
            (9, "ghp_" + "aB3" * 12), (10, "ghp_" + "aB3" * 12), (12, "lone Zx9" + "qW8eR7tY6uI5oP4" * 2)]
    out = secrets.span_digests(secrets.scan_secrets(frame(spark, rows)))
    assert got(out, ["n_assign", "n_access", "n_hex", "base_sha256"]) == brute.secrets(rows)
    by = {r.doc_id: r for r in out.collect()}
    assert by[9].spans == "" and by[9].n_example == 0 or by[9].n_live == 0      # two owners: an example
    assert by[12].spans.startswith("mixed:") and by[12].n_live == 1             # one owner: live-looking


def test_secrets_on_supplied_documents(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    out = got(queries.op5_secret_scan(spark, SF_SMALL), ["n_assign", "n_access", "n_hex", "base_sha256"])
    assert out == brute.secrets(docs)


def test_suffix_order_is_sorted():
    rng = np.random.default_rng(3)
    for _ in range(400):
        text = np.append(rng.integers(1, rng.integers(2, 6), rng.integers(0, 40)), 0)
        assert suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_suffix_dedup(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcd é") for _ in range(260))
    rows = some_texts(1)
    at = len(rows)
    for k in range(25):                                          # one passage, cut at all places, in many surroundings
        own = "".join(rng.choice("wxyz ") for _ in range(150))
        rows.append((at + k, own[:k * 5] + passage[k * 3:] + own[k * 5:]))
    rows += [(at + 30, passage * 3), (at + 31, "ab" * 400), (at + 32, "ab" * 300), (at + 33, "a" * 99), (at + 34, "a" * 101)]
    out = suffix_dedup.cut_repeats(frame(spark, rows))
    assert got(out, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]) == brute.repeated_bytes(rows)


def test_suffix_dedup_in_small_chunks(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in read(spark, SF_SMALL, "documents").collect()]
    out = suffix_dedup.cut_repeats(frame(spark, docs), with_kept=True)
    plain = brute.repeated_bytes(docs)
    assert got(out, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]) == plain
    assert all(brute.sha(bytes(r.kept)) == plain[r.doc_id][3] for r in out.collect())


def test_classes_in_any_chunks(monkeypatch):
    """What a chunk holds over to the next one does not change the result."""
    import pyarrow as pa

    rng = np.random.default_rng(2)
    rows = sorted({(int(rng.integers(0, 12)), int(rng.integers(0, 3)), int(rng.integers(0, 9)), int(rng.integers(0, 50))) for _ in range(300)})
    columns = list(zip(*rows))
    table = pa.table({"key": columns[0], "ctx": columns[1], "id": columns[2], "at": pa.array(columns[3], pa.int32()),
                      "lo": pa.array([0] * len(rows), pa.int32()), "hi": pa.array([0] * len(rows), pa.int32()), "repeat": [False] * len(rows)})
    results = []
    for size in (1, 2, 7, 1000):
        monkeypatch.setattr(suffix_dedup, "CHUNK_ROWS", size)
        found = [tuple(r.values()) for b in suffix_dedup._classes(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        results.append(sorted(found))
    assert all(r == results[0] for r in results)


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    from chartwise.llm.tokens import public_path

    rows = texts + [(900, "naïve <|endoftext|> \x1c ﬁ ² İstanbul 'S it's DON'T x_1 １２ ε̄ 漢字"), (901, "word " * 9000), (901, "word " * 9000)]
    library = Tokenizer.from_file(public_path())
    pieces = packing.pack(frame(spark, rows)).collect()
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append((p.piece, p.start, p.length, p.ids_crc32))
    for i, t in rows:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want = [(k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
        assert sorted(by[i]) == sorted(want * sum(j == i for j, _ in rows)), i
    places = {}
    for p in pieces:
        places.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for items in places.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 2048
    total = sum(p.length for p in pieces)
    assert len(places) <= -(-total // 2048) + 1


def test_packing_levels_and_evolution(spark):
    rng = np.random.default_rng(4)
    lengths = [int(x) for x in rng.integers(300, 1400, 600)]
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
                                   "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    out = packing.pack_pieces(pieces, block=64).toPandas()
    assert sorted(out.doc_id) == list(range(600)) and out.groupby("sequence_id").length.sum().max() <= 2048
    size = np.array(lengths)
    plain = len(packing.Bins(size, 2048).insert(np.argsort(-size, kind="stable").tolist()).items)
    assert out.sequence_id.nunique() <= plain * 1.03 + 2
    best = packing.evolve(size, 2048, rng, [])[0]
    assert len(best.items) <= plain and sorted(i for b in best.items for i in b) == list(range(600))


def trained(spark):
    """Documents of two kinds, far more of them than a test needs to tell them apart."""
    rng = random.Random(8)
    good = lambda: " ".join("".join(rng.choice("etaoin") for _ in range(rng.randint(2, 8))) for _ in range(40))
    rows = [(i, good() if i % 4 else f"{good()} villain {good()} VILLAIN!! ### ### ###") for i in range(400)]
    labels = [(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(400)] + [(1, None, None), (5000, 1, 0)]
    rows += [(1000, None), (1001, ""), (1002, "x " * 30000)]
    return rows, frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("module, threshold", [(quality, 0.3), (toxicity, 0.5)])
def test_pu_classifiers(spark, module, threshold):
    rows, docs, labels = trained(spark)
    out = {r.doc_id: r for r in module.classify(docs, labels).collect()}
    assert len(out) == len(rows)
    right = 0
    for i, r in out.items():
        assert r.held_out == brute.held_out(i, 5, 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
        if i < 400:
            right += r.predicted == (int(i % 4 != 0) if module is quality else int(i % 4 == 0))
    assert right >= 390
    assert out[1000].score == out[1001].score
    # held-out labels are never learned from
    flipped = labels.select("doc_id", *[F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0,
                                               1 - F.col(c)).otherwise(F.col(c)).alias(c) for c in ("quality", "toxic")])
    again = {r.doc_id: r.score for r in module.classify(docs, flipped).collect()}
    assert again == {i: r.score for i, r in out.items()}


def test_pu_without_labels(spark, texts):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    for module in (quality, toxicity):
        assert module.classify(frame(spark, texts[:9]), none).count() == 9


def test_keep_good_keeps_rows_whole(spark):
    rows, docs, labels = trained(spark)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert set(map(tuple, kept.collect())) <= set(map(tuple, docs.collect()))


def test_language(spark):
    rng = random.Random(2)
    kinds = {"en": "the of and ing tion", "de": "der ung sch keit ü", "fr": "le que eau é", "xx": "zy xq wv"}
    rows = []
    for i in range(320):
        lang = list(kinds)[i % 4]
        rows.append((i, " ".join("".join(rng.choices(kinds[lang].split(), k=3)) for _ in range(25)), lang if i % 9 else None))
    rows += [(900, None, "en"), (901, "123 !?", "en"), (902, "", None), (903, "ü", "de")]
    out = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert len(out) == len(rows)
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (900, 901, 902)) and out[903].lang_pred != "und"
    held = [(i, list(kinds)[i % 4]) for i in range(320) if brute.held_out(i, 4, 2)]
    assert all(out[i].held_out == brute.held_out(i, 4, 2) and 0 <= out[i].score <= 1 for i in out)
    assert sum(out[i].lang_pred == lang for i, lang in held) >= 0.97 * len(held)
    code = language.codewords(9)
    assert min((code[a] != code[b]).sum() for a in range(9) for b in range(a)) >= 10


def test_chat_round_trip_and_layouts(spark):
    texts = ["<|im_end|>\n<|im_start|>x", "<", "|lt|>", "<|lt|>", "<<||>", "", "a\nb", "é<|nl|>", None]
    rows = [(1, k, r, t) for k, (r, t) in enumerate([(r, t) for r in ("user", "assistant", "ro\nle<|", None) for t in texts])]
    rows += [(2, 1, "assistant", "<"), (2, 2, "assistant", "|lt|>"), (None, None, None, None), (3, 0, "user", "q" * 50000), (3, 0, "user", "a")]
    folded = chat_format.records_of(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
                                    .withColumn("layout", F.lit(1)))
    chats = chat_format.format_chats(chat_format.canonical_turns(folded))
    back = {r.conv_id: [tuple(t) for t in r.read] for r in chats.select(
        "conv_id", chat_format.read_back(F.col("formatted")).alias("read")).collect()}
    assert back[1] == [(r or "", t or "") for _, _, r, t in rows[:36]]
    assert back[None] == [("", "")] and back[3] == [("user", "a"), ("user", "q" * 50000)]
    digest = {r.conv_id: r for r in chat_format.chat_digests(chats).collect()}
    assert digest[2].loss_sha256 == brute.sha("<|lt|>") and digest[2].loss_chars == 6 and digest[3].loss_chars == 0

    mixed = spark.createDataFrame(
        [(1, "p", "r", None, None, None), (2, "p", "r", "s", None, None), (3, None, None, None, [("human", "q"), ("gpt", "a")], None),
         (4, None, None, None, None, "odd"), (5, "p", None, None, None, None)],
        "conv_id int, prompt string, response string, system string, conversations array<struct<`from`:string,value:string>>, extra string")
    out = {r.conv_id: (r.layout, [tuple(t) for t in r.turns or []]) for r in chat_format.canonical_turns(mixed).collect()}
    assert out == {1: ("prompt_response", [("user", "p"), ("assistant", "r")]),
                   2: ("system_prompt_response", [("system", "s"), ("user", "p"), ("assistant", "r")]),
                   3: ("shared", [("user", "q"), ("assistant", "a")]), 4: (None, []), 5: (None, [])}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table in ("documents", "benchmark", "labels", "conversations"):
        read(spark, SF_SMALL, table).limit(0).write.parquet(str(tmp_path / f"{table}.parquet"))
    rows = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert len(rows) == (1 if name.startswith("op3") else 0)     # op3 adds a conversation of its own


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, duck, name):
    from ..helpers import table_rows

    assert table_rows(queries.QUERIES[name](spark, SF_SMALL).toPandas()) == table_rows(duck.execute(queries.ORACLE_SQL[name]).df())


def test_pipeline_stages_against_plain_versions(spark):
    import corpus_pipeline as pipeline

    docs = read(spark, SF_SMALL, "documents")
    names = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == names
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, out))
        pairs = sorted(before.items())
        if name == "exact_dedup":
            assert set(after) == {i for i, v in brute.exact_groups(pairs).items() if v[2]}
        elif name == "ngram_jaccard_join":
            assert set(after) == {i for i, v in brute.jaccard_components(pairs, 5, 80).items() if v[1] == i}
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in read(spark, SF_SMALL, "benchmark").collect()]
            plain = brute.contamination(pairs, items)
            assert set(after) == {i for i, v in plain.items() if 2 * v[1] <= v[0]}
            assert all(after[i] == before[i] for i in after if not plain[i][4])
        else:
            assert len(after) > 0.7 * len(before) and all(after[i] == before[i] for i in after)
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_stages_keep_clean_rows_with_null_and_repeated_ids(spark):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    rows = [(1, words(1)), (None, words(1)), (None, words(2)), (None, None), (7, words(3)), (9, words(3)), (7, words(4)),
            (None, words(5)), (9, words(6))]
    left = sorted(map(str, ((r.doc_id, r.text) for r in exact_dedup.keep_last_copies(frame(spark, rows)).collect())))
    assert left == sorted(map(str, [rows[k] for k in (0, 2, 3, 5, 6, 7, 8)]))
    rows = [(3, words(1)), (7, words(1) + " more"), (7, words(2)), (7, words(2)), (8, words(2) + " more"), (9, words(4)),
            (9, words(2) + " less"), (None, words(1)), (None, words(5)), (10, None), (11, None)]
    left = sorted(map(str, ((r.doc_id, r.text) for r in ngram_join.keep_one_of_each(frame(spark, rows)).collect())))
    assert left == sorted(map(str, [rows[k] for k in (0, 2, 3, 5, 7, 8, 9, 10)]))


def test_packing_blocks_stay_small_when_nothing_fills(spark, monkeypatch):
    dealt, plain = [], packing._pack_blocks

    def spy(items, blocks, capacity, level):
        dealt.append((items.count(), blocks))
        return plain(items, blocks, capacity, level)

    monkeypatch.setattr(packing, "_pack_blocks", spy)
    lengths = [904] * 500 + [1100] * 101
    pieces = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
                                   "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    out = packing.pack_pieces(pieces, block=64).toPandas()
    assert all(n <= 64 * blocks for n, blocks in dealt) and dealt[-1][1] == 1
    assert sorted(out.doc_id) == list(range(601)) and out.groupby("sequence_id").length.sum().max() <= 2048
    assert out.sequence_id.nunique() <= 303                      # 101 pairs of unequal lengths, the rest in equal pairs: 301


def repeated_bytes_of_rows(rows, length=100):
    """A byte goes if its string also starts earlier: in a smaller id, or further left in the same one."""
    least = {}
    for i, t in rows:
        raw = t.encode()
        for p in range(len(raw) - length + 1):
            least[raw[p:p + length]] = min(least.get(raw[p:p + length], (i, p)), (i, p))
    out = []
    for i, t in rows:
        raw = t.encode()
        cut = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if least[raw[p:p + length]] < (i, p):
                cut[p:p + length] = b"\x01" * length
        out.append((i, len(raw), sum(cut), brute.sha(bytes(b for b, c in zip(raw, cut) if not c))))
    return sorted(out)


def test_suffix_dedup_of_repeated_ids(spark):
    rng = random.Random(11)
    own = lambda k, a="abcdef ": "".join(rng.choice(a) for _ in range(k))
    passage, start = own(240), own(170)
    rows = [(1, own(300))] * 2 + [(2, own(80) + passage)] * 3 + [(3, passage + own(90))] * 2 + [(4, "xy" * 200)] * 2
    rows += [(5, start + own(120)), (5, start + own(120)), (5, own(60) + start), (6, own(40) + start[20:] + own(60)), (7, own(99))]
    rows += [(8, passage[60:] + own(50)), (8, passage[60:] + own(50)), (8, passage[60:] + own(50))]
    rng.shuffle(rows)
    out = suffix_dedup.cut_repeats(frame(spark, rows).repartition(3)).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in out) == repeated_bytes_of_rows(rows)


def test_shared_windows_hold_no_hot_core():
    """A core with any number of pieces is never held or suffix-sorted whole, and gives the spans that sorting it gives."""
    import pyarrow as pa

    rng = np.random.default_rng(6)
    side = lambda k: bytes((97 + (rng.random(k) < 0.06)).astype(np.uint8))
    rows = []
    for core, n in ((1, 30), (2, 900), (3, 2), (4, 300)):
        for i in range(n):
            half = int(rng.integers(0, 2))
            h0, h1 = suffix_dedup.HALVES[half]
            l1, l2 = sorted(int(x) for x in rng.integers(h0, h1 + 1, 2))
            rows.append((core, half, i // 2, int(rng.integers(0, 9)), 200 + i % 3, l1, l2, side(l2 - h0), side(h1 - l1)))
    rows.sort(key=lambda r: (*r[:3], r[4], r[3]))
    names = ["core", "half", "id", "doc", "at", "l1", "l2", "left", "right"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), *[pa.int32()] * 3, *[pa.binary()] * 2]
    table = pa.table([pa.array(list(x), t) for x, t in zip(zip(*rows), types)], names=names)

    def covered(chunk, many):
        most, plain = [0], suffix_dedup._solve
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(suffix_dedup, "CHUNK_ROWS", chunk)
            patch.setattr(suffix_dedup, "MANY", many)
            patch.setattr(suffix_dedup, "_solve", lambda t: (most.append(max(np.unique(t.column("core").to_numpy(), return_counts=True)[1])), plain(t))[1])
            out = pa.Table.from_batches(list(suffix_dedup._shared_windows(iter(table.to_batches(max_chunksize=chunk)))))
            open_ = out.filter(out.column("win").is_valid()).sort_by([(k, "ascending") for k in ("core", "l", "win", "id", "start", "doc")])
            late = [b for b in suffix_dedup._later_windows(iter(open_.to_batches(max_chunksize=13)))]
        bytes_of = {}
        for r in [*out.filter(out.column("win").is_null()).to_pylist(), *(r for b in late for r in b.to_pylist())]:
            bytes_of.setdefault((r["id"], r["doc"]), set()).update(range(r["start"], r["end"]))
        return bytes_of, max(most)

    whole, most = covered(5000, 5000)
    assert most == 900 and whole
    for chunk, many in ((7, 20), (64, 100), (5000, 1)):
        got_, most = covered(chunk, many)
        assert got_ == whole and most <= many


def test_suffix_dedup_with_hot_cores(spark, monkeypatch):
    """Pieces of all cores as windows."""
    rng = random.Random(21)
    passage = "".join(rng.choice("abcd ") for _ in range(180))
    rows = [(k, "".join(rng.choice("wx") for _ in range(90)) + passage[k % 4:180 - k % 7] + "".join(rng.choice("yz") for _ in range(90))) for k in range(60)]
    plain = suffix_dedup._shared_windows
    many = suffix_dedup.MANY

    def all_hot(batches):
        suffix_dedup.MANY = 1
        try:
            yield from plain(batches)
        finally:
            suffix_dedup.MANY = many

    monkeypatch.setattr(suffix_dedup, "_shared_windows", all_hot)
    out = suffix_dedup.cut_repeats(frame(spark, rows))
    assert got(out, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]) == brute.repeated_bytes(rows)


def test_pipeline_run_leaves_its_last_stage_only(spark, tmp_path, monkeypatch):
    import os

    import corpus_pipeline as pipeline
    from chartwise.llm import common

    for module in (pipeline, common):
        monkeypatch.setattr(module, "shared_dir", lambda s: f"file://{tmp_path}")
    kept = common.stored(spark.range(3), "other")                           # a table of other work in this application stays
    out = pipeline.run(spark, SF_SMALL)
    assert out.count() > 0 and kept.count() == 3
    assert [n for _, d, _ in os.walk(tmp_path / "corpus-pipeline") for n in d if n[:1].isdigit() and "-" in n] == ["5-best_fit_packing"]
    assert os.listdir(tmp_path / "chartwise-llm") == [n for n in os.listdir(tmp_path / "chartwise-llm") if n.startswith("other-")]
