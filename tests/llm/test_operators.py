"""The training-data operators on small tables, against brute force."""

import collections
import datetime
import math
import zlib

import compare
import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallymill.llm import bwt, langid, lattice, mixing, packing, pii, queries, repeats, resampling, simhash, token_count, topk
from tallymill.llm.components import components

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
DOC = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, at int, id int"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(j) for i, j in zip(rng.integers(0, 20, n), rng.integers(0, 50, n)))


@pytest.fixture(scope="module")
def texts():
    """Nulls, empty and long texts, repeated rows, near copies, special strings and odd white space."""
    long = prose(1, 3000)
    found = [None, "", " \t\n", long, long, long.replace("alpha1 ", "omega "), prose(2, 90), prose(2, 90) + " more", "a", "12 34"]
    found += ["x<|endoftext|>y <|startoftext|> z", "café é    中文  it's\r\n\n  end ", "a" * 900, prose(3, 200) + " " + prose(1, 200)]
    return found + ["same words here again"] * 3


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", "fr", None][i % 3], ["b", None, "a", "c"][i % 4], 0, "clash", 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(40, 30), (41, 40), (50, 50)], "a long, b long")
    found = {r.node: r.root for r in components(links, "t").collect()}
    assert found == {i: 0 for i in range(21)} | {30: 30, 40: 30, 41: 30}


def test_token_counts(spark, docs, texts, nothing):
    tokenizer = Tokenizer.from_file(queries.BYTE_BPE)
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.token_counts(docs, queries.BYTE_BPE).collect()}
    assert got == {i: (len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    assert token_count.token_counts(nothing, queries.BYTE_BPE).count() == 0


def test_pre_tokens_are_those_of_the_tokenizer():
    tokenizer, pieces = token_count._tokenizer(queries.BYTE_BPE)
    points = [c for c in [*range(0x370), *range(0x370, 0x30000, 7)] if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 4096):
        text = "".join(f"a{chr(c)} 1{chr(c)}{chr(c)}b" for c in points[at : at + 4096])
        spans = tokenizer.pre_tokenizer.pre_tokenize_str(text)
        assert pieces(text) == [text[a:b] for _, (a, b) in spans]


def brute_prints(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(items, close):
    root = {i: i for i in items}
    while True:
        new = {i: min(root[j] for j in items if close(i, j)) for i in items}
        if new == root:
            return root
        root = new


def test_simhash(spark, docs, texts, nothing):
    prints = {i: brute_prints(t, 3) for i, t in enumerate(texts)}
    expected = linked(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (prints[i], expected[i]) for i in prints}
    assert simhash.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("limit", [200, 8_000_000])
def test_ball_hashing_finds_all_links(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "VARIANTS", limit)
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    prints = set(base.tolist())
    for x in base.tolist():
        for _ in range(6):
            prints.add(x ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 5)), replace=False)))
    prints = np.array(sorted(prints), np.uint64)
    index, bucket = simhash._buckets(prints, 8)
    pairs = []
    for b in np.unique(bucket):
        own = index[bucket == b]
        i, j = simhash._met(prints[own], int(b), 8)
        pairs += list(zip(own[i], own[j]))
    assert all((int(prints[i]) ^ int(prints[j])).bit_count() <= 3 for i, j in pairs)
    root = simhash.local_roots(len(prints), *np.array(pairs).T)
    expected = linked(range(len(prints)), lambda i, j: (int(prints[i]) ^ int(prints[j])).bit_count() <= 3)
    assert root.tolist() == [expected[i] for i in range(len(prints))]


def test_pseudonyms(spark, docs, texts):
    made = pii.Pseudonyms(b"k")
    for n in (1, 2, 10, 97, 1000):
        assert sorted(made.permute("t", v, n) for v in range(n)) == list(range(n))
    text = "card 4111 1111 1111 1111, 4111-1111-1111-1111 not 4111111111111112; ip 10.2.3.4 not 300.1.1.1 or 1.2.3; on 2020-02-29, 29/02/2020 not 2021-02-29"
    text += '; a.b1@x.example.com +1 (293) 555-9179 078-05-1120 GB82 WEST 1234 5698 7654 32 token = "2321bac4d15ec8f90433955bf9d3cf61da5bdd00"'
    new, found = made.replace(text)
    kinds = [k for k, _, _ in found]
    assert kinds == ["card", "card", "ip", "date", "date", "email", "phone", "ssn", "iban", "secret"]
    kept = "not 4111111111111112", "300.1.1.1", "1.2.3;", "not 2021-02-29", "@x.example.com", "+1 (", "GB"
    assert len(new) - len(text) == len(new.split(" ip ")[1].split()[0]) - len("10.2.3.4") and all(k in new for k in kept)
    shifted = made.replace(new)[1]
    assert [k for k, _, _ in shifted] == kinds  # pseudonyms are valid values of their kind
    cards = [new[5:24], new[26:45]]
    assert cards[0].replace(" ", "") == cards[1].replace("-", "") != "4111111111111111"
    days = [d for d in new.replace(",", " ").split() if d.count("-") == 2 and len(d) == 10 or d.count("/") == 2]
    assert datetime.date.fromisoformat(days[0]) == datetime.datetime.strptime(days[1], "%d/%m/%Y").date()
    rows = {r.doc_id: r.p for r in docs.select("doc_id", pii.pseudonymise(F.col("text"), b"k").alias("p")).collect()}
    assert all(rows[i].text == t and rows[i].found == [] for i, t in enumerate(texts))


def test_repeated_starts():
    rng = np.random.default_rng(3)
    for _ in range(200):
        length = int(rng.integers(2, 9))
        parts = [bytes(rng.integers(97, 97 + int(rng.integers(1, 4)), int(rng.integers(0, 40))).astype(np.uint8)) for _ in range(int(rng.integers(1, 6)))]
        seen = collections.Counter(t[i : i + length] for t in parts for i in range(len(t) - length + 1))
        expected = [[i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1] for t in parts]
        assert [x.tolist() for x in bwt.repeated_starts(parts, length)] == expected


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats(spark, docs, texts, nothing, hot):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(t[i : i + 400] for t in data for i in range(len(t) - 399))
    got = {r.doc_id: r for r in repeats.remove_repeats(docs, hot=hot).collect()}
    for i, t in enumerate(data):
        gone = bytearray(len(t))
        for k in range(len(t) - 399):
            if seen[t[k : k + 400]] > 1:
                gone[k : k + 400] = b"\1" * 400
        assert got[i].n_bytes == len(t) and bytes(got[i].kept) == bytes(b for b, g in zip(t, gone) if not g)
        assert sum(s.end - s.begin for s in got[i].spans) == sum(gone)
    assert repeats.remove_repeats(nothing).count() == 0


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 64))
    near = [b + 0.033 * rng.standard_normal(64) * np.linalg.norm(b) / 8 * s for b in base[:30] for s in (1, 3, 8)]
    rows = [[float(np.float32(x)) for x in v] for v in [*base, *near, base[0], base[0]]]
    rows += [None, [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0]]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(rows)] + [(None, rows[0], 1)], "vec_id long, embedding array<float>, node int")
    usable = {i: np.array(v) / np.linalg.norm(v) for i, v in enumerate(rows) if v and None not in v and np.all(np.isfinite(v)) and any(v)}
    close = lambda i, j: i == j or i in usable and j in usable and len(usable[i]) == len(usable[j]) and usable[i] @ usable[j] >= 0.95
    root = linked(range(len(rows)), close)
    links = {i: sum(close(i, j) for j in range(len(rows))) - 1 for i in range(len(rows))}
    for block in (lattice.BLOCK, 3):
        monkeypatch.setattr(lattice, "BLOCK", block)
        got = {r.vec_id: r for r in lattice.near_duplicates(df).collect()}
        found = sum(got[i].n_links for i in range(len(rows)))
        assert 0.9 * sum(links.values()) <= found and all(got[i].n_links <= links[i] for i in links)
        assert np.mean([got[i].component_id == root[i] for i in links]) > 0.9
        assert got[None].n_links == 0 and not got[None].kept and got[60].component_id == 0


def test_e8():
    short = lattice.shortest_e8()
    assert len(short) == 240 and np.allclose((short**2).sum(axis=1), 2)
    assert np.allclose(lattice.nearest_e8(short), short)
    y = np.random.default_rng(0).normal(size=(500, 8)) * 2
    best = lattice.nearest_e8(y)
    for p in short:
        assert (((y - best) ** 2).sum(axis=1) <= ((y - best - p) ** 2).sum(axis=1) + 1e-9).all()


def test_packing(spark, docs, texts, nothing):
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in enumerate(texts)}
    pieces = packing.pack(docs, queries.WORD_BPE, length=256).collect()
    covered = {i: [] for i in ids}
    sequences = collections.defaultdict(list)
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length].tobytes()
        assert bytes(p.ids) == part and p.ids_crc32 == zlib.crc32(part) and p.doc_tokens == len(ids[p.doc_id])
        covered[p.doc_id] += range(p.start, p.start + p.length)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert all(sorted(c) == list(range(len(ids[i]))) for i, c in covered.items())
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 256 and ends[-1].bit_count() == 1
    assert packing.pack(nothing, queries.WORD_BPE).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS", 60)
    monkeypatch.setattr(topk, "STEP", 16)
    rng = np.random.default_rng(6)
    vectors = [[float(x) for x in v] for v in np.round(rng.standard_normal((250, 10)), 1)]
    vectors[7], vectors[8], vectors[9], vectors[100] = None, [None] * 10, [float("inf")] * 10, vectors[3]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in enumerate(vectors)] + [(None, vectors[0], 0, 0)], "vec_id long, embedding array<double>, score int, slot int")
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in enumerate(vectors) if i not in (7, 8, 9)}
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    expected = {}
    for q in range(0, 250, 50):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], whole[i])), i) for i in whole if i != q)
        expected |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores[:10])}
    assert got == expected


def test_mixing(spark, docs, texts, nothing):
    mix = mixing.Mix(docs, block=8)
    rows = mix.taken().collect()
    assert len(rows) == len(texts) and all(r.taken <= 2 * r.size for r in rows)
    assert sorted((r.id, r.taken) for r in rows) == sorted((r.id, r.taken) for r in mixing.Mix(docs, block=8).taken().collect())
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert sum(r.taken for r in own) == math.floor(own[0].target) and own[0].target <= 2 * own[0].source_size
    assert mixing.Mix(nothing).taken().count() == 0 and mixing.Mix(nothing).uses().count() == 0


def test_slots_follow_the_golden_ratio(spark, docs):
    mix = mixing.Mix(docs, block=8)
    pieces = mix.pieces.collect()
    goals = {r.sid: r.target for r in mix.documents.collect() if r.target >= 1}
    blocks = {sid: math.ceil(math.floor(t) / 8) for sid, t in goals.items()}
    total, upper, edges = sum(goals.values()), 0.0, []
    for sid in sorted(goals):
        upper += goals[sid]
        edges.append((upper / total if sid < max(goals) else 1.0, sid))
    rank, slots, n = dict.fromkeys(goals, 0), {}, sum(blocks.values())
    for slot in range(n):
        sid = next(sid for edge, sid in edges if (slot + 1) * mixing.GOLDEN % 1 < edge)
        if rank[sid] < blocks[sid]:
            slots[sid, rank[sid]] = slot
        rank[sid] += 1
    late = [(sid, r) for sid in sorted(goals) for r in range(min(rank[sid], blocks[sid]), blocks[sid])]
    slots |= {key: n + i for i, key in enumerate(late)}
    assert {((p.sid, p["rank"]), p.slot) for p in pieces} == set(slots.items())
    by_doc = collections.defaultdict(list)
    for p in pieces:
        by_doc[p.sid, p["at"], p["size"], p.id, p.turn].append((p.slot, p["rank"], p["at"]))
    uses = {(r.sid, r["at"], r["size"], r.id): [tuple(u) for u in r.uses] for r in mix.uses().collect()}
    expected = collections.defaultdict(list)
    for (*doc, _), own in by_doc.items():
        expected[tuple(doc)].append(min(own))
    assert uses == {doc: sorted(own) for doc, own in expected.items()}
    taken = {(r.sid, r["at"], r["size"], r.id): (r.n_slots, r.first_slot) for r in mix.taken().collect() if r.taken}
    assert taken == {doc: (sum(len(v) for (*d, _), v in by_doc.items() if tuple(d) == doc), min(own)[0]) for doc, own in expected.items()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_duckdb(spark, name):
    folder = str(compare.SF_ROOT / "sf0.001")
    assert compare.differences(queries.queries()[name](spark, folder), compare.connect(folder), queries.ORACLE_SQL[name]) is None


def test_language(spark, docs, nothing):
    folder = str(compare.SF_ROOT / "sf0.01")
    got = {r.doc_id: r for r in queries.op9_language(spark, folder).collect()}
    truth = dict(duckdb.sql(f"select doc_id, lang from '{folder}/documents.parquet'").fetchall())
    held = [i for i, r in got.items() if r.held_out]
    assert set(held) == {i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.95 and np.mean([r.rejected for r in got.values()]) < 0.03
    learned = langid.fit(docs)
    rows = {r.doc_id: r.p for r in docs.select("doc_id", langid.identify(F.col("text"), learned).alias("p")).collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].rejected for i in (0, 1, 2, 9)) and langid.fit(nothing) == {}


def test_resampling(spark, docs, nothing):
    folder = str(compare.SF_ROOT / "sf0.01")
    got = {r.doc_id: r for r in queries.op10_resampling(spark, folder).collect()}
    labels = duckdb.sql(f"select doc_id, quality, toxic from '{folder}/labels.parquet'").fetchall()
    assert np.mean([got[i].kept for i, q, t in labels if q and not t]) > 0.97 and np.mean([got[i].kept for i, q, _ in labels if not q]) < 0.1
    keys = sorted((math.floor(r.gumbel_key * 2**20) for r in got.values()), reverse=True)
    cut = keys[round(resampling.KEEP * len(keys)) - 1]
    assert all(r.kept == (math.floor(r.gumbel_key * 2**20) >= cut) for r in got.values())
    ids = docs.select(F.col("doc_id").alias("id")).where("id in (3, 6)")
    assert resampling.resample(docs, ids).count() == docs.count() and resampling.resample(nothing, ids).count() == 0


def test_pipeline(spark, tmp_path, docs):
    import corpus_pipeline

    folder = str(tmp_path / "sf")
    source = str(compare.SF_ROOT / "sf0.001" / "documents.parquet")
    spark.read.parquet(source).write.parquet(f"{folder}/documents.parquet")
    now = spark.read.parquet(source)
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, stage(spark, now, folder)
        assert now.columns == columns
        now.write.parquet(f"{folder}/{name}")
        now = spark.read.parquet(f"{folder}/{name}")
        if name == "near_dedup":
            prints = {r.doc_id: brute_prints(r.text, 3) for r in before.collect()}
            root = linked(prints, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
            assert sorted(r.doc_id for r in now.collect()) == sorted(set(root.values()))
    uses = collections.Counter(r.doc_id for r in now.collect())
    assert max(uses.values()) <= 2
    packed = {(r.doc_id, r.doc_tokens) for r in corpus_pipeline.run(spark, folder).collect()}
    assert {i for i, _ in packed} == set(uses)
    odd = docs
    for _, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, folder)
    assert odd.count() > 0


def test_packing_ids_are_those_of_the_tokenizer():
    rng = np.random.default_rng(8)
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    odd = ["", " ", "İİ Σσς ΑΣ", "áb é", "<|endoftext|>x", "x<|startoftext|> y<|endoftext|>", "\x1c a\x85b\xa0c", "日本語 текст", "'LL don't I'VE ²³¼ ½a_b", "a\x00b ​ x\xady", "x" * 500]
    mixed = ["".join(rng.choice([*packing._LATIN, "'", "s", "'ll", " ", "\n"], 30)) for _ in range(2000)]
    texts = odd + mixed + ["".join(map(chr, range(0x250)))]
    wanted = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes() for t in texts]
    assert packing._words(queries.WORD_BPE).odd and list(packing.token_ids(pa.array(texts), queries.WORD_BPE, 1)) == wanted
    assert list(packing.token_ids(pa.array([None, "a"]), queries.WORD_BPE, 1))[0] == np.uint32(1).tobytes()
