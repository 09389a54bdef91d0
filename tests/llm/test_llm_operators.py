"""The operators against brute force, the libraries, round trips and held-out labels; odd rows and empty tables."""

import hashlib
import re

import numpy as np
import public_tokenizers as P
import pytest

from tidemark.llm import decontam, embed_dedup, graph, langid, line_dedup, pieces, pii, quality, simhash, token_counts, toxicity

ODD = [
    (1, "The cat sat on the mat.\nThe cat sat on the mat."), (2, None), (3, ""), (4, "  \n "), (5, "İstanbul ΣΑΣ é 你好 😀 ½²"),
    (6, "<|endoftext|> don't I'VE <|startoftext|>x"), (7, "x" * 5000), (7, "x" * 5000), (None, "no id here at all"), (8, "a\x00b\x1c c\x85d"),
    (9, "many words " * 3000), (10, "▁ already marked"),
]
WORDS = P.path("word_bpe_49k.json")
PIECES = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, empty, repeated and long texts, and columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "en", 5, 6) for r in ODD], "doc_id long, text string, lang string, n_tokens int, component_id int").repartition(3)


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return spark.read.parquet(f"{sf_small}/documents.parquet")


@pytest.fixture(scope="module")
def sf_small():
    return "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_token_counts_match_library(odd, docs):
    library = token_counts.counter(WORDS).library
    for table in (odd, docs):
        want = sorted((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids), len((r.text or "").encode())) for r in table.select("doc_id", "text").collect() if r.doc_id)
        got = sorted((r.doc_id, r.n_tokens, r.n_bytes) for r in token_counts.count_tokens(table, WORDS, budget=50).collect() if r.doc_id)
        assert got == want


def test_token_counts_of_any_letters_below_0300():
    c, random = token_counts.PrefixCounter(WORDS), np.random.default_rng(8)
    pool = [chr(i) for i in range(0x20, 0x300)]
    words = ["İstanbul", "ȺȾ", "aİb", "İ", "Ⱥ1 Ⱦx"] + ["".join(random.choice(pool, random.integers(1, 30))) for _ in range(4000)]
    words += ["".join(random.choice(["İ", "Ⱥ", "Ⱦ", "a", "B", "é", " ", "1", "'s", "<|endoftext|>"], random.integers(1, 12))) for _ in range(4000)]
    wrong = [w for w in words if c.cut(w, 2048)[0] != len(c.library.encode(w, add_special_tokens=False).ids)]
    assert not wrong


def test_token_prefixes_and_budget():
    c = token_counts.PrefixCounter(WORDS)
    text = "Thntblere of then, it's edtioner 42x"
    want = [len(c.library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1) if not text[i - 1].isspace()]
    assert list(c.prefix_counts(text)) == want
    for budget in range(len(want)):
        n, chars, tokens = c.cut(text, budget)
        fits = [i + 1 for i, w in enumerate(want) if w <= budget]
        assert (n, tokens <= budget) == (want[-1], True)
        assert chars == (max(fits) if fits else 0)


def test_embeddings_against_all_pairs(spark):
    random = np.random.default_rng(1)
    base = random.normal(size=(40, 24))
    x = np.concatenate([base, base[:20] + 0.05 * random.normal(size=(20, 24)), base[:5], np.repeat(base[:1], 30, 0) + 0.08 * random.normal(size=(30, 24))])
    ids = random.permutation(len(x))
    frame = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, n_links int")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    near = u @ u.T >= 0.95
    label = ids.copy()
    for _ in range(len(x)):
        label = np.array([label[g].min() for g in near])
    want = sorted((int(i), int(g.sum() - 1), int(c), bool(i == c)) for i, g, c in zip(ids, near, label))
    for tile in (4096, 16):
        assert sorted(map(tuple, embed_dedup.near_duplicates(frame, tile=tile).collect())) == want


def test_embeddings_odd_rows(spark):
    nan = float("nan")
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [1.0, 0.0, 0.0]), (10, [])], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embed_dedup.near_duplicates(frame).collect()}
    assert got == {1: (1, 1), 2: (1, 1), **{i: (0, i) for i in (3, 4, 5, 6, 7, 10)}}
    assert embed_dedup.near_duplicates(frame.where("vec_id > 99")).count() == 0


PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def base_of(text):
    out = []
    for no, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True, "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), no, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(out))


def test_pii_base_spans(spark, docs):
    more = ["a@b.c_d@e.f g@h.i@j.k", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.0004", "4111 1111 1111 1111-2 4111-1111-1111-1111", "+1 (555) 123-4567. +12345678901234567", "é😀 x@y.zz", "1-2" * 3000, "9" * 9000, "", None]
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    for r in pii.find(table).collect():
        assert r.base_sha256 == hashlib.sha256(base_of(texts[r.doc_id]).encode()).hexdigest(), r.doc_id


def test_pii_disclosing_terms(spark):
    some = [(i, f"agent zorblax wrote {w} to spy@x.org today") for i, w in enumerate("alpha beta gamma delta".split())]
    table = spark.createDataFrame([*some, *((10 + i, f"today nothing was wrote number {i}") for i in range(60)), (100, "the Zorblax is here"), (101, None)], "doc_id long, text string")
    assert {r.term for r in pii.disclosing_terms(table).collect()} == {"agent", "zorblax"}
    clean = {r.doc_id: r.text for r in pii.sanitise(table, removed=2.0).where("doc_id in (0, 100, 101)").collect()}
    assert clean == {0: "[term] [term] wrote alpha to [email] today", 100: "the [term] is here", 101: None}


def told_terms(rows, share=0.8, support=2):
    """Disclosing terms by counting over sets of different lines."""
    lines = {line for _, t in rows if t is not None for line in t.split("\n")}
    words = lambda line: set(re.findall(r"[^\W\d_]{4,}", line.lower()))
    entity = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    where, met, holds = {}, {}, {}
    for line in lines:
        for t in words(line):
            holds.setdefault(t, set()).add(line)
        for e in {m.lower() for m in entity.findall(line)}:
            where.setdefault(e, set()).add(line)
            for t in words(entity.sub(" ", line)):
                met.setdefault((e, t), set()).add(line)
    n, found = len(lines), {}
    for (e, t), both in met.items():
        own = np.log(n / len(where[e]))
        if len(both) >= support and own > 0 and np.log(len(both) * n / (len(where[e]) * len(holds[t]))) >= share * own:
            found[t] = max(found.get(t, 0), np.log(len(both) * n / (len(where[e]) * len(holds[t]))) / own)
    return found


def test_pii_terms_against_counting(spark):
    random = np.random.default_rng(6)
    pool = [f"{a}{b}" for a in ("alfa", "beta", "gamma", "delta") for b in ("one", "two", "ten", "six", "zoo")]
    mails = [f"user{i}@mail.example" for i in range(6)]
    line = lambda: " ".join([*random.choice(pool, 4), *([str(random.choice(mails))] if random.random() < 0.4 else [])])
    rows = [(i, "\n".join(line() for _ in range(random.integers(0, 6)))) for i in range(60)]
    rows += [(100 + i, f"secretword meets user9@mail.example in {p}") for i, p in enumerate(pool[:5])]
    rows += [(200 + i, rows[i % 7][1]) for i in range(40)] + [(300, None), (301, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = told_terms(rows)
    got = {r.term: r.disclosed for r in pii.disclosing_terms(table).collect()}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want) and "secretword" in want


def test_pii_entity_in_every_line(spark):
    table = spark.createDataFrame([(1, "alpha x@y.zz foo"), (2, "alpha x@y.zz bar")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_email, r.spans) for r in pii.find(table).collect()) == [(1, 1, "email:6:12"), (2, 1, "email:6:12")]


def test_pii_many_addresses_in_one_text(spark):
    """Time by the number of matches, not by its square: 20,000 addresses in one text."""
    many = " ".join(f"name{i}@host{i % 7}.org" for i in range(20_000))
    table = spark.createDataFrame([(1, many), (2, "a@b.cc " * 64), (3, "a@b.cc " * 65), (4, "a@b.cc " * 63)], "doc_id long, text string")
    for r in pii.find(table).collect():
        text = many if r.doc_id == 1 else "a@b.cc " * (62 + {2: 2, 3: 3, 4: 1}[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(base_of(text).encode()).hexdigest()


def print_of(text):
    import xxhash

    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_against_all_pairs(odd, docs):
    for table in (docs.select("doc_id", "text"), odd.where("doc_id is not null").select("doc_id", "text")):
        prints = {r.doc_id: print_of(r.text) for r in table.collect()}
        label = {d: d for d in prints}
        for _ in prints:
            new = {d: min(label[e] for e, q in prints.items() if (p ^ q).bit_count() <= 2) for d, p in prints.items()}
            if new == label:
                break
            label = new
        got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(table).collect()}
        assert got == {d: (prints[d], label[d]) for d in prints}
    kept = simhash.keep_one(odd)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [*set(label.values()), None])) and kept.columns == odd.columns


def test_thresholds_cover_the_distance():
    costs = [[0.0, 5.0, 9.0, 50.0], [0.0, 1.0, 2.0, 3.0], [0.0, 7.0, 8.0, 9.0]]
    cost, chosen = simhash.allocate(costs, 2)
    assert sum(chosen) == 2 - 3 + 1 and cost == min(costs[0][a + 1] + costs[1][b + 1] + costs[2][c + 1] for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3) if a + b + c == 0)


def test_decontamination(spark):
    items = spark.createDataFrame([(1, "If Anna buys 12 apples for 3 dollars and sells 12 apples to Bob for 5 dollars what is her profit"), (2, "Short one here is ok"), (3, None), (4, "two words")], "item_id long, text string")
    docs = [
        (1, "junk. If Carla buys 40 apples for 7 dollars and sells 40 apples to Dan for 9 dollars what is her profit? end"),
        (2, "If Carla buys 40 apples for 7 dollars and sells 41 apples to Dan for 9 dollars what is her profit"),
        (3, None), (4, ""), (5, "if anna buys 12 apples for 3 dollars and sells 12 apples to bob for 5 dollars what is her profit"), (6, "so: short one here is ok"), (7, "two words"),
    ]
    table = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id): r.changed > 0 for r in decontam.contaminations(table, items).collect()}
    assert got == {(1, 1): True, (5, 1): False, (6, 2): False}  # 2: one value of the item meets two in the document
    assert sorted(r.doc_id for r in decontam.remove_contaminated(table, items).collect()) == [2, 3, 4, 7]
    assert decontam.contaminations(table.where("doc_id > 99"), items).count() == decontam.contaminations(table, items.where("item_id > 9")).count() == 0


def test_decontamination_of_altered_items(spark):
    words = "the old keeper of the harbour light wrote each evening into a small blue book how many ships had passed the outer rocks before the tide turned again".split()
    one = words[:13] + ["very"] + words[13:]
    two = words[:10] + ["very"] + words[10:19] + ["quite"] + words[19:]
    price = "a farmer sells 12 eggs on monday then walks home and rests for a while until the evening comes then counts what is left and finds 12 coins in a bag"
    long = " ".join(f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe", "ri") for b in ("bo", "da", "fi", "gu", "ho", "ja", "ke", "lu", "me", "no"))
    items = spark.createDataFrame([(1, " ".join(words)), (2, price), (3, long), (4, "港口的老看守每晚都写下有多少船经过")], "item_id long, text string")
    docs = [
        (1, " ".join(one)), (2, " ".join(two)), (3, price.replace("12 coins", "13 coins")), (4, "so " + " ".join(long.split()[20:36]) + " it ends"),
        (5, "他说港口的老看守每晚都写下有多少船经过。"), (6, " ".join(long.split()[20:30])),
    ]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (4, 3), (5, 4)}


def test_decontamination_leaves_other_numbers_alone(spark):
    story = "{} went to market with {} apples and {} pears and came home with {} coins {} plums and {} nuts in the evening"
    items = spark.createDataFrame([(1, "2 4 6 8 10 12 14 16"), (2, story.format("then Anna", 3, 5, 7, 9, 11)), (3, "1 3 5 7 9 11 13 15")], "item_id long, text string")
    docs = [
        (1, "totals 31 55 72 81 90 14 77 65 12 8 and so on"), (2, "so " + story.format("then Bob", 40, 40, 40, 40, 40)), (3, "so " + story.format("then Bob", 13, 15, 17, 19, 21)),
        (4, "the row 1 3 5 7 9 11 13 15 again"), (5, " ".join(map(str, range(100, 4100)))), (6, "the row 2 4 6 8 10 12 14 17 again"),
    ]
    got = {(r.doc_id, r.item_id) for r in decontam.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert got == {(3, 2), (4, 3)}


def test_altered_items_are_found(spark):
    """Recall on every given item of twenty words or more: as it stands, with one word put in, and with its numbers changed."""
    folder = "/root/testdata/sf0.01"
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    chosen = [(r.item_id, r.text) for r in items.collect() if r.text and len(r.text.split()) >= 20]
    docs, wanted = [], []
    for n, (item, text) in enumerate(chosen):
        words = text.split()
        ways = [words, [*words[: len(words) // 2], "indeed", *words[len(words) // 2 :]], [re.sub(r"\d+", lambda m: str(int(m[0]) + 7), w) for w in words]]
        for k, way in enumerate(ways):
            docs.append((10 * n + k, "before it stands this and then " + " ".join(way) + " and this comes after it"))
            wanted.append((10 * n + k, item))
    got = {(r.doc_id, r.item_id) for r in decontam.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert len(wanted) > 30 and sum(w in got for w in wanted) >= 0.97 * len(wanted)


def test_stages_take_columns_of_any_name(spark):
    names = ["doc_id", "a.b", "text", "gone", "place", "root", "component", "doc", "c0", "lang"]
    row = lambda d, t: tuple({"doc_id": d, "text": t, "lang": "en"}.get(c, f"{c}-{d}") for c in names)
    docs = spark.createDataFrame([row(1, "one text of some words here"), row(2, "one text of some words here"), row(3, "another one")], ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in names))
    items = spark.createDataFrame([(1, "another one")], "item_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(docs).collect())) == [row(1, "one text of some words here"), row(3, "another one")]
    assert decontam.remove_contaminated(docs, items).columns == simhash.keep_one(docs).columns == langid.keep_identified(docs).columns == names
    assert decontam.remove_contaminated(docs, items).count() == 3


def test_line_dedup(spark, odd):
    line = "the quick brown fox jumps over the lazy dog while nine other animals of the wood look on from the hill and wait for the evening to come"
    near = line.replace("evening", "evenings")
    other = "completely different words stand here and nothing of them was seen in any line before"
    table = spark.createDataFrame([(1, f"{line}\nshort\n{other}", 0), (2, f"{near}\nshort", 0), (3, f"{line.upper()}!\n{'-' * 30}", 0), (4, None, 0), (5, "", 0), (None, line, 0)], "doc_id long, text string, _pos int")
    got = {r.doc_id: (r.text, r["_removed"]) for r in line_dedup.dedup_lines(table).collect()}
    # Short lines repeat like any other; what has no letter or digit is compared as it stands.
    assert got == {1: (f"{line}\nshort\n{other}", 0), 2: ("", 2), 3: ("-" * 30, 1), 4: (None, 0), 5: ("", 0), None: (line, 0)}
    assert line_dedup.without_repeated_lines(odd).columns == odd.columns and line_dedup.without_repeated_lines(odd).count() == len(ODD)
    assert line_dedup.without_repeated_lines(odd.where("doc_id > 99")).count() == 0


def test_lines_with_one_letter_changed_go(spark):
    text = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text is not null").orderBy("doc_id").collect()
    lines = [line for line in dict.fromkeys(x for r in text for x in r.text.lower().split("\n")) if re.fullmatch(r"[a-z ,.]+", line) and line[len(line) // 2].isalpha() and 11 <= len(line.split()) <= 20][:200]
    changed = [line[: len(line) // 2] + ("q" if line[len(line) // 2] != "q" else "z") + line[len(line) // 2 + 1 :] for line in lines]
    of = lambda s: {s[i : i + 5] for i in range(len(s) - 4)}
    alike = [(a, b) for a, b in zip(lines, changed) if len(of(a) & of(b)) >= 0.8 * len(of(a) | of(b))]
    assert len(alike) > 100
    table = spark.createDataFrame([(1, "\n".join(a for a, _ in alike)), (2, "\n".join(b for _, b in alike))], "doc_id long, text string")
    got = {r.doc_id: r["_removed"] for r in line_dedup.dedup_lines(table).collect()}
    assert got[2] > 0.97 * len(alike)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 100), (300, 300), (None, 1)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 200: 100}


def test_language(odd, spark, sf_small):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.97
    by = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 4)) and len(langid.identify(odd).collect()) == len(ODD)
    assert langid.identify(odd.where("doc_id > 99")).count() == 0
    kept = langid.keep_identified(odd)
    assert kept.schema == odd.schema and {r.doc_id for r in kept.collect()} >= {1, 9} and not {2, 3, 4} & {r.doc_id for r in kept.collect()}


def test_a_rare_language_is_learned_beside_a_common_one(spark):
    """One language holds 99 of 100 texts; the model's bounds are far below what it alone would fill."""
    random = np.random.default_rng(9)

    def vocabulary(letters, n):
        return ["".join(random.choice(list(letters), random.integers(3, 9))) for _ in range(n)]

    common, rare = vocabulary("abcdefghij", 3000), vocabulary("fghijklmno", 200)
    text = lambda words: " ".join(random.choice(words, 30))
    rows = [(i, text(common), "common") for i in range(1980)] + [(5000 + i, text(rare), "rare") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in langid.identify(docs, sample=100, units=150).collect()}
    assert all(found[i] == lang for i, _, lang in rows)


def test_what_has_no_letter_is_undetermined_and_marks_belong_to_words(spark):
    odd = [(1, "½ ² ① Ⅷ ٣ 12 _ !?"), (2, ""), (3, None), (4, "\u0301"), (5, "ab")]
    labelled = [(10 + i, t, lang) for i in range(30) for t, lang in (("हिन्दी में लिखा हुआ", "hi"), ("written in letters", "en"))]
    docs = spark.createDataFrame([(*r, None) for r in odd] + labelled + [(200, "हिन्दी हुआ", None), (201, "letters " + "z" * 5000, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[5][0] != "und"
    assert got[200][0] == "hi" and got[201][0] == "en"
    assert langid._WORD.findall("हिन्दी e\u0301te\u0301 a²b") == ["हिन्दी", "e\u0301te\u0301", "a", "b"]


def test_words_of_plain_texts_are_the_same():
    random = np.random.default_rng(4)
    for pool in (range(0x20, 0x300), range(0x20, 0x700), [0x61, 0xB2, 0xBD, 0x301, 0x20, 0x915, 0x93F, 0x2167, 0x1D7D8, 0x5F]):
        for _ in range(500):
            text = "".join(chr(c) for c in random.choice(list(pool), 20))
            assert langid.words_of(text) == langid._WORD.findall(text)


def test_words_are_judged_over_their_whole_length(spark):
    """Two unknown words that differ only beyond their first two hundred letters."""
    docs = [(i, "abcde fghij " * 3, "one") for i in range(1, 30)] + [(100 + i, "vwxyz rstuq " * 3, "two") for i in range(1, 30)]
    model = langid.fit(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    scorer = langid.Scorer(model)
    start = "abcde" * 40
    assert langid.judge(model, scorer, start + "fghij" * 300)[0] == "one" and langid.judge(model, scorer, start + "vwxyz" * 300)[0] == "two"


@pytest.mark.parametrize("module,label,least", [(quality, "quality", 0.9), (toxicity, "toxic", 0.85)])
def test_classifiers(spark, odd, module, label, least):
    folder = "/root/testdata/sf0.01"
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = module.assess(table, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r[label] for r in found]) > least
    for chosen in (labels.where("doc_id < 0"), labels):
        got = module.assess(odd, chosen).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert module.assess(odd.where("doc_id > 99"), labels).count() == 0


def test_isotonic_is_monotone():
    x, y = quality.isotonic(np.arange(6.0), np.array([0, 0.4, 0.2, 0.9, 0.5, 1.0]), np.ones(6))
    assert np.allclose(y, [0, 0.3, 0.7, 1.0]) and np.allclose(x, [0, 1.5, 3.5, 5])


def test_pieces_encode_and_decode(odd, docs):
    model = pieces.pieces_of(PIECES, 1.0).model
    for table in (odd, docs):
        encoded = pieces.encode(table, PIECES)
        texts = [(r.doc_id, r.text or "") for r in table.select("doc_id", "text").collect()]
        assert sorted((str(d), model.encode(t)) for d, t in texts) == sorted((str(r.doc_id), r.ids) for r in encoded.collect())
        back = sorted((str(r.doc_id), r.text) for r in pieces.decode(encoded, PIECES).collect())
        assert back == sorted((str(d), t.replace("▁", " ")) for d, t in texts)
        for r in encoded.collect():
            spelt = {model.decode(s.ids) for s in r.samples}
            assert len({tuple(s.ids) for s in r.samples}) == len(r.samples) and len(spelt) == 1
    assert pieces.encode(odd.where("doc_id > 99"), PIECES).count() == 0


def test_samples_are_without_replacement():
    p = pieces.pieces_of(PIECES, 1.0)
    chunks = ["▁then", "▁of"]
    lattice = pieces.Lattice(p, chunks)

    def ways(c, i=0):
        if i == len(c):
            yield (), 0.0
        for j in range(i + 1, len(c) + 1):
            k = p.model.piece_to_id(c[i:j])
            if p.text[k] == c[i:j]:
                for rest, w in ways(c, j):
                    yield (k, *rest), w + p.weight[k]

    every = [(a + b, v + w) for a, v in ways(chunks[0]) for b, w in ways(chunks[1])]
    total = np.logaddexp.reduce([w for _, w in every])
    prob = {a: float(np.exp(w - total)) for a, w in every}
    n = 4000
    found = pieces.sample(lattice, [np.array([0, 1])] * n, pieces.mix(np.arange(n, dtype=np.uint64)), 3)
    names = [[tuple(lattice.ids(s[0]).tolist()) for s in f] for f in found]
    assert all(len(set(f)) == 3 for f in names)
    for a, q in prob.items():
        assert abs(np.mean([f[0] == a for f in names]) - q) < 0.04
        assert abs(np.mean([f[1] == a for f in names]) - sum(r * q / (1 - r) for b, r in prob.items() if b != a)) < 0.04
    assert abs(np.mean([sum(np.exp(s[1]) / s[3] for s in f) for f in found]) - 1) < 0.05  # inclusion scores are unbiased


def test_sampling_draws_once_for_each_set_and_finds_every_segmentation(monkeypatch):
    """A path's priorities take one draw, however long it is; searched to the end, all segmentations come once."""
    p = pieces.pieces_of(PIECES, 1.0)
    lattice = pieces.Lattice(p, ["▁then", "▁of"])
    key = pieces.mix(np.array([7], np.uint64))
    found = pieces.sample(lattice, [np.array([0, 1])], key, 10_000)[0]
    names = {tuple(lattice.ids(s[0]).tolist()) for s in found}
    values = [s[2] for s in found]
    assert 10 < len(names) == len(found) < 10_000 and values == sorted(values, reverse=True)
    assert abs(sum(np.exp(s[1]) for s in found) - 1) < 1e-9 and all(s[3] == 1 for s in found)
    drawn, plain = [], pieces.mix
    monkeypatch.setattr(pieces, "mix", lambda x: drawn.append(np.size(x)) or plain(x))
    (one, two), chunks = pieces.sample(lattice, [np.array([0, 1] * 500)], key, 2)[0], 1000
    walked = len(one[0]) + len(two[0])
    assert sum(drawn) <= walked + 6 * chunks  # ways take a draw for each arc, and their chunks' keys; sets none of these


def test_vectors_are_read_without_an_object_for_each_number():
    """Sliced batches and mixed dimensions give the rows they hold; numbers never become Python objects."""
    import pyarrow as pa

    held = [[1.0, 2.0], [3.0, 4.0, 5.0], [6.0, 7.0], [8.0, 9.0, 10.0], [11.0, 12.0]]
    batch = pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.float32()))], ["embedding"]).slice(1)
    got = {d: (at.tolist(), x.tolist(), x.dtype) for d, at, x in embed_dedup.matrices(batch)}
    assert got == {2: ([1, 3], [held[2], held[4]], np.float64), 3: ([0, 2], [held[1], held[3]], np.float64)}
    split = pa.chunked_array([pa.array(held[::2], pa.list_(pa.float64())).slice(1), pa.array(held[::2], pa.list_(pa.float64()))])
    assert embed_dedup.matrix(split).tolist() == [*held[2::2], *held[::2]]
