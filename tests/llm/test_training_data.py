"""The training-data operators against plain Python, on odd and on given rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tributary.llm import (
    components,
    decontaminate,
    licenses,
    line_dedup,
    mixing,
    quality_cascade,
    queries,
    simhash,
    substring_dedup,
    token_files,
    toxicity,
    url_filter,
)

SF = "/root/testdata/sf0.001"
DARK = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (5, None),
    (6, ""),
    (7, " \n\t "),
    (8, "one"),
    (9, "Ärger İ ﬁn’s x́ 12ab3 <|endoftext|>!! \x00 q"),
    (10, "word " * 3000),
    (None, "a text without an id, long enough to have some words in it all the same"),
    (11, "日本語 テスト。\tok\r\nx"),
    (9, "Ärger İ ﬁn’s x́ 12ab3 <|endoftext|>!! \x00 q"),
]


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def given(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_token_files_round_trip(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    rows = [r for r in ODD if r[0] is not None] + given(spark)[:50]
    token_files.write_tokens(docs(rows), str(tmp_path / "t"), queries.word_bpe(), 49_408, shards=5)
    got = rows_of(token_files.read_tokens(spark, str(tmp_path / "t"), 49_408), "doc_id", "start", "n_tokens", "ids_crc32")
    tokenizer, at, expected, flat = Tokenizer.from_file(queries.word_bpe()), 0, [], []
    for doc_id, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
        flat += ids
    by_id = lambda found: sorted((r[0], *r[2:]) for r in found)
    assert by_id(got) == by_id(expected)
    assert {r[1] for r in got} == {r[1] for r in expected} or len({r[0] for r in rows}) < len(rows)
    shards = [token_files.open_shard(str(f), np.dtype("<u2")) for f in (tmp_path / "t").glob("part-*") if f.stat().st_size]
    whole = np.concatenate([s[0] for s in sorted(shards, key=lambda s: s[3])])
    assert sorted(whole.tolist()) == sorted(flat) and len(whole) == at


def test_token_files_of_an_empty_table(spark, docs, tmp_path):
    token_files.write_tokens(docs([]), str(tmp_path / "t"), queries.word_bpe(), 49_408, shards=2)
    assert token_files.read_tokens(spark, str(tmp_path / "t"), 49_408).count() == 0


def plain_fingerprint(text):
    words = DARK.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles)) if shingles else 0


@pytest.mark.parametrize("crowded", [1, 64])
def test_simhash_groups(spark, docs, crowded):
    rows = [r for r in ODD if r[0] is not None] + [(100 + i, t) for i, t in given(spark)]
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    root = {fp: fp for _, fp in fps}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    distinct = list(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for d, fp in fps:
        least[find(fp)] = min(d, least.get(find(fp), d))
    expected = sorted([(d, f"{fp:016x}", least[find(fp)]) for d, fp in fps], key=repr)
    assert rows_of(simhash.near_duplicates(docs(rows), crowded=crowded), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.keep_one(docs(rows).withColumn("fp", F.lit(1)).withColumn("_simhash", F.lit("x")), crowded=crowded)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp", "_simhash"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_simhash_of_nothing_and_without_ids(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    found = simhash.near_duplicates(docs([(None, "a b c d"), (None, "a b c d")])).collect()
    assert [r.component_id for r in found] == [None, None]
    assert simhash.keep_one(docs([(None, "a b c d"), (None, "a b c d"), (None, "q")])).count() == 2


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    found = dict(map(tuple, components.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_contamination_with_short_and_odd_items(spark, docs):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(1, text(25)), (2, text(10)), (3, "w1, W2"), (4, None), (5, "..."), (6, text(9)), (None, text(12)), (2, "x1 É x1")]
    rows = list(ODD) + [(20 + i, text(40)) for i in range(20)]
    rows += [(50, "A " + items[0][1][:200].upper() + " z"), (51, items[5][1]), (52, text(5) + " " + items[1][1]), (None, items[1][1])]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for key, t in items:
        w = cut(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(key)
    expected = []
    for key, t in rows:
        w, hit, found = cut(t), set(), set()
        for size in range(1, 11):
            for i in range(len(w) - size + 1):
                keys = windows.get(tuple(w[i : i + size]))
                if keys:
                    hit.update(range(i, i + size))
                    found |= keys
        expected.append((key, len(w), len(hit), sorted(str(k) for k in found if k is not None)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in decontaminate.contamination(docs(rows), benchmark).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    clean = decontaminate.drop_contaminated(docs(rows), benchmark)
    assert 50 not in {r.doc_id for r in clean.collect()} and clean.columns[1] == "text"
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs(rows), empty).where("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs([]), benchmark).count() == 0


def test_clean_rows_stay_beside_contaminated_ones_of_their_id(spark, docs):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(None, item), (None, "clean, without an id"), (1, "some " + item), (1, "clean"), (1, "clean"), (2, None)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    left = rows_of(decontaminate.drop_contaminated(docs(rows), benchmark), "doc_id", "text")
    assert left == sorted([(None, "clean, without an id"), (1, "clean"), (1, "clean"), (2, None)], key=repr)


def test_cascade_order_never_changes_the_verdict(docs):
    table = docs([*ODD, (30, "a fair text of words " * 2 + " ".join(f"w{i}" for i in range(80)))])
    one = quality_cascade.judge(table)
    costs = [{"rule": "symbols", "rejected": 0.5, "cost": 1e-6}, {"rule": "few_words", "rejected": 0.5, "cost": 1.0}]
    order = [r.name for r in quality_cascade.cascade_order(costs)]
    assert order.index("symbols") < order.index("few_words")
    two = quality_cascade.judge(table, rules=list(reversed(quality_cascade.RULES)), sample_rows=1)
    assert rows_of(one, "doc_id", "n_words", "kept") == rows_of(two, "doc_id", "n_words", "kept")
    assert {r.doc_id for r in one.where("kept").collect()} == {30}
    measured = quality_cascade.rule_costs(table)
    assert [m["rule"] for m in measured] == [r.name for r in quality_cascade.RULES]
    assert all(0 <= m["rejected"] <= 1 and m["cost"] > 0 for m in measured)
    assert quality_cascade.rule_costs(docs([])) == []
    assert quality_cascade.judge(docs([])).count() == 0


def test_toxic_marks_are_counted_over_all_training_labels(spark, docs):
    terms = [f"t{i}xq{i}" for i in range(20)]
    rows = [(i, f"plain words of row{i} " + (terms[i // 8 % 20] if i % 8 == 0 else "fair")) for i in range(1600)]
    labels = spark.createDataFrame([(i, 1, int(i % 8 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    held = {r.doc_id for r in labels.where(toxicity.held_out(F.col("doc_id"))).collect()}
    told = {t.rsplit(" ", 1)[1] for i, t in rows if i % 8 == 0 and i not in held}
    model = toxicity.train(docs(rows), labels, sample_rows=60)
    words = toxicity.find_words(toxicity.pa.array(sorted(told)), toxicity.LETTERS)
    assert len(told) == 20 and np.isin(toxicity.word_hashes(words, lower=True), model.marks).all()


def test_toxicity_learns_from_training_labels_only(spark, docs):
    rng = random.Random(5)
    common = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        words, toxic = rng.choices(common, k=30), i % 8 == 0
        if toxic:
            words[3:5] = ["vile" + rng.choice("abcdefgh") * 3, rng.choice(["scumbag", "rotten"])]
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    odd = [(d if d is None else d + 1000, t) for d, t in ODD]
    scored = toxicity.score(docs(rows + odd), table)
    assert scored.count() == len(rows) + len(ODD)
    got = {r.doc_id: r for r in scored.collect()}
    assert all(got[i].predicted == labels[i][2] for i in range(600))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(600))
    flipped = table.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.score(docs(rows + odd), flipped).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in range(600))
    none = toxicity.score(docs(rows[:9]), table.where("doc_id < 0"))
    assert {r.predicted for r in none.collect()} == {0}


def test_url_rules_and_host_trust(spark):
    link = '<a class="x" href="https://{}/p">z</a>'
    pages = [
        (1, "http://good.org/a", link.format("friend.net")),
        (2, "https://A.Example.ORG/es/1?q", None),
        (3, "https://bad.com/de/9#x", ""),
        (4, "https://friend.net/", "<a href='/local'>"),
        (5, "https://fan.net/x", link.format("bad.com") + link.format("BAD.com")),
        (6, None, None),
        (7, "no scheme", None),
        (8, "ftp://org", None),
        (9, "https://friend.net/", "<a href='/local'>"),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = url_filter.judge(table, url_filter.rule_table(spark, queries.URL_RULES))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}
    assert got == {
        1: ("good.org", "/a", "org/", "allow"),
        2: ("a.example.org", "/es/1", "example.org/es/", "block"),
        3: ("bad.com", "/de/9", "com/de/", "block"),
        4: ("friend.net", "/", None, "allow"),
        5: ("fan.net", "/x", None, "block"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("org", "", None, "allow"),
        9: ("friend.net", "/", None, "allow"),
    }
    assert url_filter.judge(table.limit(0), url_filter.rule_table(spark, queries.URL_RULES)).count() == 0


def test_page_rank_against_plain_iteration(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 1), ("d", "c", 4), ("c", "e", 1)]
    rank = url_filter.page_rank(
        spark.createDataFrame(edges, "src string, dst string, weight long"),
        spark.createDataFrame([("a", 0.75), ("d", 0.25)], "host string, share double"),
        rounds=15,
        enough=0.0,
    )
    seeds, now = {"a": 0.75, "d": 0.25}, {"a": 0.75, "d": 0.25}
    for _ in range(15):
        sent = {}
        for src, dst, w in edges:
            total = sum(x[2] for x in edges if x[0] == src)
            sent[dst] = sent.get(dst, 0) + 0.85 * now.get(src, 0) * w / total
        kept = 1 - sum(sent.values())
        now = {h: sent.get(h, 0) + kept * seeds.get(h, 0) for h in {*sent, *seeds}}
    got = {r.host: r.rank for r in rank.collect()}
    assert got == pytest.approx(now)


def test_license_scan_and_inheritance(spark):
    files = [
        (1, "a/LICENSE", "intro\n\n" * 4 + "Released under the MIT License."),
        (2, "a/b/c.txt", "nothing here"),
        (3, "a/b/LICENSE.md", "Licensed under CC BY-NC 4.0."),
        (4, "a/d.txt", "# Licensed under the Apache License, Version 2.0\ncode"),
        (5, "e.txt", None),
        (6, None, ""),
        (7, "a/b/LICENSE", "Licensed under the license of the king"),
        (2, "a/b/c.txt", "nothing here"),
    ]
    table = spark.createDataFrame(files, "key long, path string, text string")
    got = rows_of(licenses.scan(table), "key", "license", "how")
    assert got == sorted(
        [(1, "MIT", "own"), (2, "CC-BY-NC-4.0", "inherited"), (2, "CC-BY-NC-4.0", "inherited"), (3, "CC-BY-NC-4.0", "own"),
         (4, "Apache-2.0", "own"), (5, None, None), (6, None, None), (7, "CC-BY-NC-4.0", "inherited")], key=repr
    )
    assert licenses.scan(table.limit(0)).count() == 0


def test_licenses_are_found_on_any_line(spark):
    files = [(1, "a/b.txt", "some code\n" * 40 + "Released under the MIT License.\nmore"), (2, "a/c.txt", "some code\n" * 40)]
    got = rows_of(licenses.scan(spark.createDataFrame(files, "key long, path string, text string")), "key", "license", "how")
    assert got == [(1, "MIT", "own"), (2, None, None)]


def test_license_weights_count_every_word(spark):
    files = [(i, f"{i}.txt", "en de la") for i in range(300)] + [(300, "x.txt", "Released under the MIT License en de la")]
    found = licenses.own_licenses(spark.createDataFrame(files, "key long, path string, text string"))
    assert rows_of(found.where("own is not null"), "key", "own") == [(300, "MIT")]


def test_wrapped_license_notices(spark):
    bsd = licenses.TEMPLATES["BSD-3-Clause"]
    files = [
        (1, "a/LICENSE", "Copyright someone\n\n" + bsd.replace("without ", "without\n") + "\nand so on"),
        (2, "a/b.txt", "nothing"),
        (3, "c.txt", " * released\n * under the\n * MIT license\n"),
    ]
    got = rows_of(licenses.scan(spark.createDataFrame(files, "key long, path string, text string")), "key", "license", "how")
    assert got == [(1, "BSD-3-Clause", "own"), (2, "BSD-3-Clause", "inherited"), (3, "MIT", "own")]


def spans_of(lines, size):
    """Words that are compared with a template of ``size`` words."""
    words = [w for line in lines for w in line]
    yield from [*lines, words]
    for n in range(size - size // 4, size + size // 4 + 1):
        yield from (words[i : i + n] for i in range(len(words) - n + 1))


def own_by_hand(texts):
    cut = [[re.findall("[a-z0-9]+", x.lower()) for x in (t or "").split("\n")] for t in texts]
    held = Counter(w for lines in cut for w in set().union(*lines))
    idf = {w: math.log((1 + len(texts)) / (1 + n)) + 1 for w, n in held.items()}

    def unit(words):
        vector = {w: n * idf.get(w, math.log(1 + len(texts)) + 1) for w, n in Counter(words).items()}
        norm = math.sqrt(sum(v * v for v in vector.values())) or 1
        return {w: v / norm for w, v in vector.items()}

    out = []
    for lines in cut:
        best = (0.8, "", None)
        for name, template in sorted(licenses.TEMPLATES.items()):
            words = re.findall("[a-z0-9]+", template.lower())
            of = unit(words)
            for span in spans_of(lines, len(words)):
                if span not in lines and (not span or span[0] not in words) and len(span) < sum(map(len, lines)):
                    continue  # windows begin with a word of the template
                cosine = sum(v * of.get(w, 0) for w, v in unit(span).items())
                if cosine > best[0] + 1e-9 or (best[2] is None and cosine >= 0.8):
                    best = (cosine, name, name)
        out.append((best[2], best[2] and round(best[0], 6)))
    return out


@pytest.mark.parametrize("known", [1, 20_000])
def test_own_licenses_against_plain_python(spark, monkeypatch, known):
    monkeypatch.setattr(licenses, "KNOWN_WORDS", known)
    rng, texts = random.Random(5), [t for _, t in [*ODD, *given(spark)[:80]]]
    for template in [*licenses.TEMPLATES.values()] * 6:
        words = template.split(" ")
        for _ in range(rng.randrange(4)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(["en", "und", "x" + str(rng.randrange(99)), "İ", "the"]))
        if rng.random() < 0.5:
            del words[rng.randrange(len(words))]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n"]) for w in ["intro\n", *words, "\nend"]))
    table = spark.createDataFrame([(i, f"{i}.txt", t) for i, t in enumerate(texts)], "key long, path string, text string")
    found = licenses.own_licenses(table).orderBy("key").collect()
    got = [(r.own, r.own and round(r.similarity, 6)) for r in found]
    assert got == own_by_hand(texts)
    assert sum(own is not None for own, _ in got) > 5


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a == b
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def test_lines_at_one_edit(spark, docs):
    rng = random.Random(11)
    base = ["".join(rng.choices("abc dé", k=n)) for n in (20, 21, 31, 32, 33, 63, 64, 65, 70, 150) for _ in range(3)]
    lines = []
    for line in base * 4:
        at = rng.randrange(len(line) + 1)
        lines.append(rng.choice([line, line[:at] + "x" + line[at:], line[:at] + line[at + 1 :], line[:at] + "y" + line[at + 1 :]]))
    rng.shuffle(lines)
    short = ["short", "shot", "a", "b", "", "ab", "  "]
    rows = [(20 + i, "\n".join([*lines[5 * i : 5 * i + 5], short[i % 7]])) for i in range(24)] + list(ODD)
    earlier, expected = [], []
    for doc_id, text in sorted({r for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0)):
        gone = []
        for number, line in enumerate(text.split("\n") if text is not None else []):
            if not line:
                continue
            if any(distance_one(line, x) for x in earlier):
                gone.append(number)
            earlier.append(line)
        expected.append((doc_id, len(text.split("\n")) if text is not None else 0, gone))
    found = line_dedup.repeated_lines(docs(rows))
    got = [(r.doc_id, r.n_lines, list(r.removed)) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    left = {r.doc_id: r.text for r in line_dedup.without_lines(docs(rows), found).collect()}
    for doc_id, _, gone in expected:
        text = dict(rows)[doc_id]
        assert left[doc_id] == (text if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
    assert line_dedup.repeated_lines(docs([])).count() == 0


def test_line_dedup_stays_in_the_jvm(docs):
    plan = line_dedup.repeated_lines(docs([(1, "x" * 30)]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_mixing_redistributes_to_siblings_first(spark, docs):
    rows = [(i, "w " * 10, "en", "a") for i in range(100)] + [(200 + i, "w " * 10, "fr", "b") for i in range(10)]
    rows += [(400 + i, "w " * 10, "de", "c") for i in range(400)] + [(None, None, None, None), (900, "", "en", "a")]
    table = docs(rows).withColumn("domain", F.when(F.col("lang") == "de", "y").otherwise("x"))
    chosen = mixing.choose(table, ["domain", "lang", "source"], {("x", "fr"): 3}, 0.4, 2, 1)
    taken = {r.lang: r.n for r in chosen.groupBy("lang").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n")).collect()}
    # 2040 of 5100 tokens: 1020 a domain; fr would get 765, has 200 with both epochs; its brother takes the rest
    assert taken == {"fr": 200, "en": 820, "de": 1020}
    mixed = mixing.mix(table, chosen)
    assert mixed.columns == table.columns
    assert mixed.where("lang = 'fr'").count() == 20
    again = mixing.choose(table, ["domain", "lang", "source"], {("x", "fr"): 3}, 0.4, 2, 1)
    assert rows_of(again, "doc_id", "copies") == rows_of(chosen, "doc_id", "copies")
    assert mixing.choose(table.limit(0), ["domain", "lang", "source"], {}, 0.4, 2, 1).count() == 0


def test_passages_in_smaller_documents(spark, docs):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["É,", "x."]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [text(n) for n in (12, 13, 14, 60)]
    rows = list(ODD) + [(20 + i, text(rng.randrange(30)) + "\n" + rng.choice(shared) + " \t" + text(rng.randrange(30))) for i in range(40)]
    rows += [(300, rows[20][1]), (301, rows[20][1]), (302, "a b " * 40), (303, "a b " * 30), (None, shared[3])]
    cut = lambda t: DARK.findall(t or "")
    first = {}
    for d, t in rows:
        w = cut(t)
        for i in range(len(w) - 12 if d is not None else 0):
            g = tuple(w[i : i + 13])
            first[g] = min(d, first.get(g, d))
    expected = []
    for d, t in rows:
        w, gone = cut(t), set()
        for i in range(len(w) - 12 if d is not None else 0):
            if first[tuple(w[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = substring_dedup.remove_passages(docs(rows), shards=3)
    assert rows_of(found, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=repr)
    assert substring_dedup.remove_passages(docs([])).count() == 0


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    left = [documents]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left.append(queries_stored(stage(spark, left[-1], SF)))
        assert left[-1].columns == documents.columns, name
    counts = [x.count() for x in left[:4]]
    assert counts == sorted(counts, reverse=True)
    assert len({plain_fingerprint(r.text) for r in left[2].collect()}) == counts[2]
    tokens = corpus_pipeline.STAGES[-1][1](spark, left[-1], SF)
    assert sorted(r.doc_id for r in tokens.collect()) == sorted(r.doc_id for r in left[-1].collect())


def queries_stored(df):
    from tributary.llm.storage import stored

    return stored(df, "test-stage")
