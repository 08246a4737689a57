"""Operators on edge cases, empty tables and brute-force versions."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_cases import WORD, components, edge_docs, edge_rows, label_rows, no_docs, prose
from pyspark.sql import functions as F

from tarmac.llm import imatch, langid, line_rules, lm, mixing, packing, quality, repeats, secrets, simhash
from tarmac.llm.common import read_documents, read_labels, tokenizer_path
from tarmac.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"


def by_rows(df):
    return Counter(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect())


TABLES = {
    "quality": lambda s, d: quality.quality_table(d, label_rows(s, [(1, 1, 0), (11, 0, 0), (10, 0, None), (None, 1, 0), (14, None, 0)])),
    "mixing": lambda s, d: mixing.draw(d, ["doc_id"]),
    "simhash": lambda s, d: simhash.component_table(d),
    "packing": lambda s, d: packing.pack_documents(d, tokenizer_path()),
    "lm": lambda s, d: lm.lm_table(d),
    "langid": lambda s, d: langid.language_table(d),
    "line_rules": lambda s, d: line_rules.line_rules(d),
    "secrets": lambda s, d: secrets.secret_table(d),
    "imatch": lambda s, d: imatch.fingerprint_table(d),
    "repeats": lambda s, d: repeats.repeat_table(d),
}


@pytest.mark.parametrize("name", TABLES)
def test_empty_table_gives_empty_result(spark, name):
    assert TABLES[name](spark, no_docs(spark)).count() == 0


def test_quality_edges(spark):
    rows = TABLES["quality"](spark, edge_docs(spark)).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_quality_learns_held_out_labels(spark):
    found = quality.quality_table(read_documents(spark, SF), read_labels(spark, SF)).join(
        read_labels(spark, SF).where("quality is not null").select("doc_id", "quality"), "doc_id").toPandas()
    assert (found.predicted == found.quality).mean() > 0.9


def plain_draw(rows):
    """The contract's targets by repeated resharing."""
    size = [len(WORD.findall(t or "")) for _, t, *_ in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in sources}
    weight = {s: 1 + i % 3 for i, s in enumerate(sources)}
    target, free, left = {}, set(sources), sum(size)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * total[s] + 1e-9]
        if not over:
            break
        for s in over:
            target[s] = 3 * total[s]
            left -= target[s]
            free.discard(s)
    return size, total, target | share


def test_mixing_edges(spark):
    rows = edge_rows()
    size, total, target = plain_draw(rows)
    got = mixing.draw(edge_docs(spark), ["doc_id", "source"]).collect()
    assert sorted(r["size"] for r in got) == sorted(size)
    taken: Counter = Counter()
    for r in got:
        assert r.source_size == total[r.source] and abs(r.target - target[r.source]) < 1e-5
        assert r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s, t in target.items():
        largest = max(n for n, x in zip(size, rows, strict=True) if x[3] == s)
        assert abs(taken[s] - t) <= largest / 2 + 1e-6
    assert by_rows(mixing.draw(edge_docs(spark), ["doc_id"])) == by_rows(mixing.draw(edge_docs(spark), ["doc_id"]))


def test_mixing_equals_its_sql(spark, tmp_path):
    edge_docs(spark).select("doc_id", "text", "source").write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = Counter((i, n, s, round(t, 4), k) for i, n, s, t, k in con.execute(ORACLE["op2_source_mix"]).fetchall())
    got = mixing.draw(edge_docs(spark), ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert Counter((i, n, s, round(t, 4), k) for i, n, s, t, k in got) == want


def test_mix_repeats_rows_and_keeps_columns(spark):
    docs = edge_docs(spark)
    drawn = mixing.draw(docs, ["doc_id", "text"]).where(F.col("size") > 0).collect()
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(r.taken for r in drawn) == sum(len(WORD.findall(r.text)) for r in mixed.select("text").collect())


def test_simhash_components(spark):
    rows = [(r.doc_id, r.text) for r in read_documents(spark, SF).select("doc_id", "text").collect()] + [(i + 10_000 if i else None, t) for i, t, *_ in edge_rows()]
    got = simhash.component_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [simhash.simhash(t or "", 4) for _, t in rows]
    root = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    least: dict = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    want = Counter((i, f"{p:016x}", least.get(r)) for (i, _), p, r in zip(rows, prints, root, strict=True))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_tiles_of_large_keys_lose_nothing(spark):
    rng = np.random.default_rng(4)
    centre = int(rng.integers(0, 2**62))
    values = {centre}
    while len(values) < 300:
        v = centre
        for b in rng.choice(64, rng.integers(1, 5), replace=False):
            v ^= 1 << int(b)
        values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r.a, r.b) for r in simhash.link_fingerprints(df, "fp", 4, tile=40).collect()]
    place = {v: i for i, v in enumerate(signed)}
    assert len(set(components(len(signed), [(place[a], place[b]) for a, b in links]))) == 1


def test_keep_one_of_each_group(spark):
    docs = edge_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    rows = edge_rows()
    prints = [simhash.simhash(r[1] or "", 4) for r in rows]
    root = components(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    want = Counter(min((r[0] is None, r[0] or 0) for r, g in zip(rows, root, strict=True) if g == group) for group in set(root))
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect()) == want


def test_packing_is_gapless_and_complete(spark):
    docs = edge_docs(spark)
    got = packing.pack_documents(docs, tokenizer_path(), group_rows=6, with_ids=True).collect()
    assert {c for r in got for c in [len(r.ids) == r.length, r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())]} == {True}
    ends: Counter = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends[r.sequence_id] == r.offset
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
    encoder = packing.Encoder(tokenizer_path())
    want = Counter((r[0], len(encoder.encode(r[1] or "")) // 4 + 1) for r in edge_rows())
    per_doc: Counter = Counter()
    for r in got:
        per_doc[r.doc_id] += r.length
    assert per_doc == {i: sum(n * c for (j, n), c in want.items() if j == i) for i, _ in want}


def test_packing_certificate(spark):
    docs = spark.createDataFrame([(i, prose(i, 20 + 37 * i % 900)) for i in range(120)], "doc_id long, text string")
    got = packing.pack_documents(docs, tokenizer_path(), group_rows=40, certificate=True).collect()
    groups: dict = {}
    for r in got:
        if r.length < 2048:
            groups.setdefault((r.sequence_id >> 56, r.sequence_id >> 28), []).append(r)
        else:
            assert (r.bins, r.bound) == (1, 1)
    assert len(groups) > 1
    for rows in groups.values():
        assert {(r.bins, r.bound) for r in rows} == {(len({r.sequence_id for r in rows}), packing.lower_bound(np.array([r.length for r in rows]), 2048))}
        assert rows[0].bins >= rows[0].bound
    plain = packing.pack_documents(docs, tokenizer_path(), group_rows=40)
    assert "bins" not in plain.columns


def test_lm_base_counts_by_hand(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)  # most tokens then meet their counts in the join
    rows = edge_rows()
    got = lm.lm_table(edge_docs(spark)).collect()
    tokens = [(t or "").encode().lower().split() + [b""] for _, t, *_ in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, *_ in rows]
    counts = Counter(w for ws, h in zip(tokens, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter((r[0], h, len(ws), sum(counts[w] > 0 for w in ws), n,
                    round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4))
                   for r, ws, h in zip(rows, tokens, held, strict=True))
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_language_edges_and_accuracy(spark):
    rows = langid.language_table(edge_docs(spark)).collect()
    for r in rows:
        assert 0 <= r.score <= 1
        if r.doc_id in (3, 4, 5, 7):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("en", "de", "fr")
    docs = read_documents(spark, SF)
    got = langid.language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.95


def plain_line_counts(text: str) -> tuple:
    words = WORD.findall(text)
    places: dict = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_line_rules_by_hand(spark):
    rows = [(r.doc_id, r.text) for r in read_documents(spark, SF).select("doc_id", "text").collect()]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows] + [(r[0], r[1], r[3]) for r in edge_rows()], "doc_id long, text string, source string")
    got = line_rules.line_rules(docs).collect()
    want = Counter((i, *plain_line_counts(t or "")) for i, t in [*rows, *((r[0], r[1]) for r in edge_rows())])
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.base_failed and r.kept)


def test_boilerplate_lines_per_host(spark):
    menu = "home news about contact login search help terms privacy imprint"
    rows = [(i, f"{menu}\nown line number {i} " + " ".join(f"w{i}x{j}" for j in range(25)), "a") for i in range(30)]
    rows += [(100 + i, f"{menu}\nshort text {i} " + " ".join(f"v{j}" for j in range(12)), "a") for i in range(30)]
    rows += [(200 + i, f"{menu}\nshort text {i} " + " ".join(f"u{i}x{j}" for j in range(12)), f"h{i}") for i in range(30)]  # another host each
    rows += [(300 + i, f"{menu} copied page " + " ".join(f"c{j}" for j in range(30)), "b") for i in range(30)]  # one text
    got = {r.doc_id: r for r in line_rules.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), line_share=0.0).collect()}
    assert all(got[i].kept and got[i].boilerplate_words == 10 for i in range(30))
    assert not any(got[100 + i].kept for i in range(30))  # fewer than 20 words left
    assert all(got[200 + i].kept and not got[200 + i].boilerplate_words for i in range(30))
    assert all(got[300 + i].kept for i in range(30))


def test_secrets_found_and_redacted(spark):
    rows = [(i, f"words here and there token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" and on", "en", "s", 0) for i in range(40)]
    rows += [(100 + i, f"card {4000000000000000 + i * 7919} and path one/two/three/v{i}5 then plain-words-with-{i}-dashes-in here", "en", "s", 0) for i in range(40)]
    rows += [(200, None, None, None, None), (201, "", None, None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = secrets.secret_table(docs).collect()
    assert {r.doc_id for r in got if r.is_secret} == set(range(40))
    assert all(r.start == rows[r.doc_id][1].index('"') + 1 and r.length == 40 for r in got if r.is_secret)
    clean = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert len(clean) == len(rows) and clean[200].text is None
    assert all(secrets.REDACTED in clean[i].text and clean[i].n_chars == len(clean[i].text) for i in range(40))
    assert all(clean[100 + i].text == rows[40 + i][1] for i in range(40))


def test_secrets_from_given_findings(spark):
    findings = spark.createDataFrame(
        [("a1b2" * 10, 'the token = "', '" x', 1.0)] * 20 + [("word-word-word-2024", "see ", " x", 0.0)] * 20,
        "candidate string, before string, after string, label double")
    got = secrets.secret_table(edge_docs(spark), findings).where("is_secret").collect()
    assert [r.doc_id for r in got] == [13]


@pytest.mark.parametrize("part_bytes", [8 << 20, 40_000])
def test_fingerprints_by_hand(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(imatch, "PART_BYTES", part_bytes)
    rows = [(r.doc_id, r.text) for r in read_documents(spark, SF).select("doc_id", "text").collect()] + [(500, None), (501, ""), (None, "no id")]
    got = imatch.fingerprint_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    following = order[1:] + order[:1]
    want = Counter((i, len(t or ""), hashlib.sha256(imatch.edited(t or "", n or "").encode()).hexdigest())
                   for (i, t), (_, n) in zip(order, following, strict=True))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    of = {r.doc_id: r for r in got}
    for (i, t), (j, _) in zip(order, following, strict=True):
        assert of[i].near_next == imatch.likeness(of[i].fingerprint, of[j].fingerprint)
        assert of[i].near_edited == imatch.likeness(of[i].fingerprint, of[i].edited_fingerprint)
    texts: dict = {}
    for i, t in rows:
        texts.setdefault(t or "", set()).add(of[i].fingerprint)
    assert all(len(v) == 1 for v in texts.values())
    assert np.mean([r.near_edited for r in got]) > 0.25 > 0.05 > np.mean([r.near_next for r in got])


def test_fingerprint_edges(spark):
    got = imatch.fingerprint_table(edge_docs(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows())


def plain_repeats(rows) -> Counter:
    raws = [(t or "").encode() for _, t in rows]
    starts = Counter(b[i:i + 200] for b in raws for i in range(len(b) - 199))
    want: Counter = Counter()
    for (doc_id, _), b in zip(rows, raws, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 199):
            if starts[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        runs = int((np.diff(np.r_[False, gone].astype(int)) == 1).sum())
        want[(doc_id, len(b), bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]), int(gone.sum()), runs)] += 1
    return want


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeats_by_hand(spark, hot):
    rows = [(r.doc_id, r.text) for r in read_documents(spark, SF).select("doc_id", "text").limit(80).collect()]
    rows += [(r[0], r[1][:8000] if r[1] else r[1]) for r in edge_rows()]
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), hot=hot).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept), r.n_removed, r.n_spans) for r in got) == plain_repeats(rows)


def test_copies_and_variants_by_hand(spark):
    """Many copies and a few variants: every byte is judged."""
    base = prose(9, 200)
    half = len(base) // 2
    rows = [(i, base) for i in range(240)] + [(500, base[:half] + " other " + base[half:]), (501, "start " + base[40:]), (502, base[:half - 30]),
                                              (503, prose(10, 120))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = repeats.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_bytes, bytes(r.kept), r.n_removed, r.n_spans) for r in got) == plain_repeats(rows)


def test_lm_scores_the_order_of_words(spark):
    text = "the small dog saw the large cat under the old tree"
    shuffled = " ".join(sorted(text.split()))
    rows = [(i, text if i % 2 else "a cat and a dog") for i in range(200, 260)] + [(1, text), (2, shuffled), (3, None)]
    got = {r.doc_id: r for r in lm.lm_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].score > got[2].score + 1 and got[1].n_bytes == got[2].n_bytes == len(text) + 2
    assert got[3].n_bytes == 1
    assert all(abs(r.bits_per_byte + r.score * math.log2(10) / r.n_bytes) < 1e-9 for r in got.values())


def test_assigned_values_are_taken_whole(spark):
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    texts = {'password = "P@ss!word2024" x': "P@ss!word2024", "pwd: 'correct#horse9battery'": "correct#horse9battery",
             'db_password: "hunter2$abcdefghijk"': "hunter2$abcdefghijk", "password=Tr0ub4dor&3xyz and on": "Tr0ub4dor&3xyz",
             'passwd = "a pass phrase; of words"': "a pass phrase; of words", 'token = "never%closed9 here': "never%closed9",
             'secret = "with \\" quote1" x': 'with \\" quote1', "x-api-key: k1!k2,k3;k4": "k1!k2,k3;k4", f"Authorization: Bearer {jwt} x": jwt, f"see {jwt} x": jwt,
             '{"api-key": "it\'s;1234"}': "it's;1234"}
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = secrets.candidates(docs.withColumn("key", F.col("text")), F.col("text"), "key")
    found = (secrets.in_contexts(found) if "contexts" in found.columns else found).select("key", "candidate", "before").collect()
    for text, value in texts.items():
        assert value in {r.candidate for r in found if r.key == text}, text
    named = spark.createDataFrame(found).where(F.col("before").rlike(secrets.NAME_BEFORE)).collect()
    assert all(any(r.key == t and r.candidate == v for r in named) for t, v in texts.items() if not t.startswith("see"))


def test_every_occurrence_is_judged(spark):
    key = "ab12" * 9
    text = f"{key} first bare {key}{key} then \U0001f600 token = \"{key}\" end"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = [r for r in secrets.candidates(docs, F.col("text"), "doc_id").collect() if r.candidate == key]
    starts = [i for i in range(len(text)) if text.startswith(key, i)]
    assert (row.start, row.occurrences) == (0, 4)
    assert {(c.before, c.after) for c in row.contexts} == {(text[max(0, i - 40):i], text[i + 36:i + 76]) for i in (starts[0], starts[1], starts[1] + 36, starts[-1])}
    findings = spark.createDataFrame(
        [(key[::-1], 'the token = "', '" x', 1.0)] * 20 + [(key[::-1], "see ", " x", 0.0)] * 20, "candidate string, before string, after string, label double")
    got = {r.length: r for r in secrets.secret_table(docs, findings).collect()}
    assert got[36].is_secret and got[36].start == 0 and not got[72].is_secret


def test_labels_do_not_restate_the_name(spark):
    texts = [(i, " ".join(f"word{chr(97 + j)}{chr(97 + i % 26)}" for j in range(20)) + f" see {hashlib.sha1(str(i).encode()).hexdigest()} there") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = secrets.candidates(docs, F.col("text"), "doc_id")
    labels = secrets.labelled_findings(docs, secrets.in_contexts(found) if "contexts" in found.columns else found)
    named = F.col("before").rlike(secrets.NAME_BEFORE)
    kinds = {(r.named, r.hex, r.label) for r in labels.select(named.alias("named"), F.col("candidate").rlike("^[0-9a-f]{40}$").alias("hex"), "label").distinct().collect()}
    assert {(n, True, 1.0) for n in (True, False)} | {(n, False, v) for n in (True, False) for v in (0.0, 1.0)} == kinds
    assert all(r.is_secret for r in secrets.secret_table(docs).where("length = 40").collect())


def test_copies_do_not_fill_the_training_sample(spark):
    texts = [f"words {' '.join(f'own{chr(97 + i)}{chr(97 + j)}' for j in range(20))} token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" and slug-of-{1000 + i} on" for i in range(8)]
    docs = spark.createDataFrame([(t,) for t in [*texts, *[t for t in texts for _ in range(30)]]], "text string")
    docs = docs.unionByName(spark.createDataFrame([(f"in place {i} the token = \"{hashlib.sha1(b'0').hexdigest()}\"",) for i in range(30)], "text string"))
    found = secrets.candidates(docs, F.col("text"), "text")
    found = secrets.in_contexts(found) if "contexts" in found.columns else found
    rows = secrets.labelled_findings(docs, found, sample=8).collect()
    real = [hashlib.sha1(str(i).encode()).hexdigest() for i in range(8)]
    assert Counter(r.candidate for r in rows if r.candidate in real) == dict.fromkeys(real, 1)
    assert {r.candidate for r in rows} >= {hashlib.sha256(t.encode()).hexdigest()[:40] for t in texts}


def test_boilerplate_limit_does_not_grow_with_the_host(spark):
    menu = "home news about contact login search help terms privacy imprint"
    rows = [(i, (f"{menu}\n" if i < 12 else "") + f"own line number {i} " + " ".join(f"w{i}x{j}" for j in range(25)), "a") for i in range(1000)]
    got = line_rules.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("boilerplate_words = 10").collect()
    assert {r.doc_id for r in got} == set(range(12))


def test_kept_documents_lose_their_boilerplate(spark):
    menu = "Home news   about contact"
    own = [f"line one of {i}\n\n" + " ".join(f"w{i}x{j}" for j in range(25)) for i in range(30)]
    rows = [(i, f"{menu}\n{own[i]}\n{menu.lower()}", "a", 1, "x") for i in range(30)]
    rows += [(100 + i, f"{menu}\nshort {i}", "a", 1, "x") for i in range(20)] + [(200, own[0] + f"\n{menu}", None, 7, "x"), (0, rows[0][1], "a", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, kept string")
    got = line_rules.clean_documents(docs)
    assert got.dtypes == docs.dtypes
    assert Counter((r.doc_id, r.text, r.n_chars, r.kept) for r in got.collect()) == Counter(
        [(i, own[i], len(own[i]), "x") for i in [*range(30), 0]] + [(200, rows[50][1], 7, "x")])
    counted = {r.doc_id: r for r in line_rules.line_rules(docs).collect()}
    assert counted[3].boilerplate_words == 8 and counted[3].kept and counted[100].boilerplate_words == 4 and not counted[100].kept
