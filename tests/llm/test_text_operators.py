"""Text operators on odd rows and, on the smallest tables, against brute force."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import connect, differences
from odd import LONG, PASSAGE, WORDS, benchmark, no_docs, odd_docs, rows
from pairpulse.llm import (buckets, decontamination, language, licenses, lines, mixing, near_dedup, paragraphs,
                           personal_data, sharding)
from pairpulse.llm.oracles import ORACLES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())


def groups(ids, links):
    """Smallest member reachable from each id."""
    name = {i: i for i in ids}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        name[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, SMALL), connect(SMALL), ORACLES[name]) is None


# Licenses

def test_license_scan_of_odd_rows(spark):
    found = licenses.license_scan(odd_docs(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows())
    by_id = {r.doc_id: r for r in found}
    assert (by_id[2].n_words, by_id[2].n_base, by_id[2].first_word, by_id[2].labels, by_id[2].score) == (0, 0, None, "", 0)
    mit = by_id[11]
    assert (mit.n_words, mit.n_base, mit.first_word, mit.last_word, mit.base_labels) == (8, 4, 0, 6, "cc-by,mit")
    assert by_id[1].base_labels == "gpl" and by_id[1].first_word == len(PASSAGE.split()) + 6
    assert licenses.license_scan(no_docs(spark)).count() == 0


def test_a_statement_with_an_inserted_word_is_one_span(spark):
    text = ("Permission is hereby granted, free of charge, to really any person obtaining a copy of this "
            "software and associated documentation files")
    found = licenses.license_scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert found.labels == "mit-notice" and found.n_base == 0 and 0.6 < found.score < 1


# SimHash near-duplicates

def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    runs = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates_equal_brute_force(spark, docs):
    fps = {i: fingerprint(t) for i, t in docs.items()}
    ids = sorted(fps)
    a = np.array([fps[i] for i in ids], np.uint64)
    close = np.argwhere(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1))
    name = groups(ids, [(ids[x], ids[y]) for x, y in close])
    found = entry.queries()["op3_simhash_near_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {
        i: (f"{fps[i]:016x}", name[i]) for i in ids}


@pytest.mark.parametrize("node_rows", [4, 10_000])
def test_trie_finds_every_link_of_crowded_fingerprints(spark, node_rows):
    random = np.random.default_rng(1)
    centres = random.integers(0, 1 << 63, 12)
    fps = np.unique(np.concatenate([centres] + [centres[random.integers(0, 12, 60)] ^ (1 << b) ^ (1 << c)
                                                for b, c in random.integers(0, 62, (12, 2))]))
    a = fps.view(np.uint64)
    links = np.argwhere(np.triu(np.bitwise_count(a[:, None] ^ a[None, :]) <= 2, 1))
    name = groups(range(len(fps)), links.tolist())
    frame = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    got = near_dedup.fingerprint_links(frame, 2, node_rows).collect()
    at = {int(x): i for i, x in enumerate(fps)}
    assert groups(range(len(fps)), [(at[r.a], at[r.b]) for r in got]) == name


def test_near_duplicates_of_odd_rows(spark):
    found = near_dedup.near_duplicates(odd_docs(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows())
    name = {r.doc_id: r.component_id for r in found if r.doc_id}
    assert name[6] == name[1] == 1 and name[3] == name[2] == 2
    kept = near_dedup.one_of_each_group(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and 6 not in ids and 3 not in ids and ids[4] == 1
    assert near_dedup.one_of_each_group(no_docs(spark)).count() == 0


# Decontamination

def test_leaks_equal_brute_force(spark, docs):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()

    def shingles(text):
        w = WORD.findall(lower(text))
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    held = {i: shingles(t) for i, t in docs.items()}
    expected = {}
    for item, text in items:
        own = shingles(text)
        for doc, every in held.items():
            if not set(own) & set(every):
                continue
            for at in range(len(every) - len(own) + 1):
                shared = sum((Counter(own) & Counter(every[at:at + len(own)])).values())
                share = shared / (2 * len(own) - shared)
                if share >= 0.8:
                    expected[doc, item] = max(share, expected.get((doc, item), 0))
    found = entry.queries()["op1_decontamination"](spark, SMALL).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(expected)


def test_index_finds_every_fingerprint_within_the_radius():
    random = np.random.default_rng(2)
    items = decontamination.Items(list(range(30)), [random.integers(0, 1 << 63, 20).astype(np.uint64) for _ in range(30)],
                                  np.full(30, 24))
    index = decontamination.Index(items)
    (length,) = index.by_length
    fps = index.by_length[length][3]
    masks = np.array([sum(1 << int(b) for b in random.choice(64, n, replace=False))
                      for n in random.integers(0, 14, 4000)], np.uint64)
    asked = fps[random.integers(0, len(fps), 4000)] ^ masks
    got = set(zip(*(x.tolist() for x in index.candidates(asked, length))))
    near = np.argwhere(np.bitwise_count(asked[:, None] ^ fps[None, :]) <= decontamination.RADIUS)
    assert got == {tuple(x) for x in near.tolist()}


def test_cut_and_edited_items_are_leaks():
    random = np.random.default_rng(5)
    texts = [[f"w{x}" for x in random.integers(0, 5000, n)] for n in (48, 50, 52, 55, 58, 60) * 5]
    items = decontamination.prepared([(i, " ".join(w)) for i, w in enumerate(texts)])
    index = decontamination.Index(items)
    import pyarrow as pa

    cut = [" ".join(w[:-n]) for n in (1, 3, 5) for w in texts]
    found = decontamination._found(pa.array(cut), items, index)
    assert all((i, i % len(texts)) in found for i in range(len(cut)))
    assert found[0, 0] == (43 / 44, 0, 47)
    rest = [f"x{i}" for i in range(40)]
    edited = [" ".join(rest + w[:at] + ["other"] + w[at + 1:] + rest) for w in texts for at in range(len(w))]
    item = [i for i, w in enumerate(texts) for _ in w]
    found = decontamination._found(pa.array(edited), items, index)
    size = np.array([len(texts[i]) - 4 for i in item])
    broken = np.array([min(5, at + 1, len(w) - at) for w in texts for at in range(len(w))])
    similar = (size - broken) / (size + broken) >= 0.8
    assert similar.sum() > 1000
    assert all((row, item[row]) in found for row in np.flatnonzero(similar))


def test_leaks_of_odd_rows(spark):
    found = decontamination.leaks(odd_docs(spark), benchmark(spark), "doc_id").collect()
    assert {r.doc_id for r in found} == {1, 6, 8}
    assert {r.item_id for r in found} == {1, None}
    kept = decontamination.without_leaks(odd_docs(spark), benchmark(spark))
    assert kept.columns == odd_docs(spark).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows() if r[0] not in (1, 6, 8))
    assert decontamination.leaks(no_docs(spark), benchmark(spark), "doc_id").count() == 0
    assert decontamination.leaks(odd_docs(spark), benchmark(spark).limit(0), "doc_id").count() == 0


# Lines

def test_edit_distance_equals_the_table():
    random = np.random.default_rng(3)

    def table(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        return row[-1]

    for _ in range(500):
        a, b = ("".join(random.choice(list("abc"), random.integers(0, 12))) for _ in range(2))
        assert lines.edit_distance(a, b) == table(a, b)


def test_pairs_aligned_together_equal_pairs_alone():
    """Pairs of all lengths and alphabets, near the least similarity, and letters that no band may take for others."""
    random = np.random.default_rng(5)
    texts = []
    for n in (0, 3, 40, 150, 400, 900):
        for letters in ("ab", "abcdefgh ij", "a\u65e5\u672c\uffff", "x\U0001d518y\0"):
            for share in (0, 0.1, 0.19, 0.21, 0.9) * 14:
                line = list(random.choice(list(letters), n))
                own = [c if random.random() > share / 2 else str(random.choice(list(letters))) for c in line
                       if random.random() > share / 4]
                texts += ["".join(line), "".join(own)]
    x = np.arange(0, len(texts), 2)
    found = lines._similar_pairs(texts, x, x + 1)
    for i, j, similar in zip(x, x + 1, found):
        a, b = texts[i], texts[j]
        most = max(len(a), len(b)) * (1 - lines.LEAST_SIMILARITY) + 1e-6
        assert similar == (lines.edit_distance(a, b) <= most)
    assert 0.2 < found.mean() < 0.95


def test_open_buckets_of_any_size_are_linked(spark):
    """Lines of one bucket, few or many, of which the least is near none of the others."""
    for n in (5, lines.FEW_MEMBERS + 9):
        buckets = spark.range(1, n + 1).selectExpr("7L key", "id unit")
        payload = spark.range(1, n + 1).selectExpr("id unit", "0L s0", "0L s1", "if(id = 1, 'far away', 'near by') line")

        def verified(pairs):
            return pairs.filter("a > 1")

        def listed(members):
            a, b = (members.select("key", F.col("unit").alias(x), F.col("component").alias(f"{x}_c")) for x in "ab")
            return a.join(b, "key").filter("a < b and a_c <> b_c").select("a", "b")

        joined = lines.linked(buckets, verified, payload, lines._similar_rows, lines.FEW_MEMBERS, listed)
        assert {(r.node, r.component) for r in joined.collect()} == {(i, 2) for i in range(2, n + 1)}


def test_line_groups_equal_brute_force(spark, docs):
    """All pairs of the distinct lines by edit similarity, whatever the features say."""
    own = [(i, n, " ".join(WORD.findall(lower(line)))) for i, t in docs.items()
           for n, line in enumerate((t or "").split("\n"))]
    own = [x for x in own if x[2]]
    units = sorted({x[2] for x in own}, key=len)
    size = np.array([len(u) for u in units])
    letters = sorted(set("".join(units)))
    bag = np.array([[u.count(c) for c in letters] for u in units], np.int16)
    links = []
    for x in range(len(units)):
        last = np.searchsorted(size, size[x] / 0.8 + 1e-6, "right")
        more = bag[x + 1:last] - bag[x]
        # An edit changes one letter, so it mends one letter too many and one too few at most.
        least = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
        for y in x + 1 + np.flatnonzero(least <= size[x + 1:last] * 0.2 + 1e-6):
            if lines._similar(units[x], units[y]):
                links.append((x, int(y)))
    assert links
    name = groups(range(len(units)), links)
    at = {u: name[i] for i, u in enumerate(units)}
    first = {}
    for i, n, text in sorted(own):
        first.setdefault(at[text], (i, n))
    found = lines.line_groups(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert {(r.doc_id, r.line): r.kept for r in found} == {(i, n): first[at[t]] == (i, n) for i, n, t in own}


def test_lines_are_grouped_by_edit_similarity_alone(spark, docs):
    """All pairs of a sample of lines and of their edited copies, whatever the features say."""
    random = np.random.default_rng(11)
    units = sorted({" ".join(WORD.findall(lower(line))) for t in docs.values() for line in (t or "").split("\n")})
    units = [u for u in units if 30 <= len(u) <= 300]
    units = [units[i] for i in random.choice(len(units), 150, replace=False)]
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def typos(line, n):
        out = list(line)
        for at in random.choice([i for i, c in enumerate(line) if c != " "], n, replace=False):
            out[at] = random.choice(letters)
        return "".join(out)

    def word(line):
        out = line.split()
        out[random.integers(len(out))] = "".join(random.choice(letters, 6))
        return " ".join(out)

    copies = [(typos(u, 1), typos(u, max(1, len(u) // 20)), word(u)) for u in units]
    every = sorted({*units, *(c for own in copies for c in own)})
    frame = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    group = {every[r.doc_id]: r.group for r in lines.line_groups(frame).collect()}
    links = [(x, y) for x in range(len(every)) for y in range(x)
             if abs(len(every[x]) - len(every[y])) <= 60 and lines._similar(every[x], every[y])]
    found = [group[every[x]] == group[every[y]] for x, y in links]
    assert len(links) >= 3 * len(units) and np.mean(found) >= 0.99
    name = groups(range(len(every)), links)
    assert all(name[x] == name[y] for x, a in enumerate(every) for y, b in enumerate(every[:x]) if group[a] == group[b])


def test_lines_of_odd_rows(spark):
    found = {r.doc_id: r for r in lines.line_counts(odd_docs(spark)).collect()}
    assert 2 not in found and 3 not in found and 5 not in found and None not in found
    assert (found[1].n_lines, found[1].n_kept) == (2, 2) and found[6].n_kept == 0
    assert (found[15].n_lines, found[15].kept_lines) == (50, "0")
    assert lines.line_counts(no_docs(spark)).count() == 0


# Personal data

def test_base_spans_equal_brute_force(spark, docs):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
                "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, hit):
        digits = re.sub("[^0-9]", "", hit)
        if kind == "ip":
            return all(int(x) <= 255 for x in hit.split("."))
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(x - 9 if x > 9 else x for x in twice) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    tricky = ["a@b.c@d.e.f x@y@z.com a@b.com_c@d.org", "1.2.3.4.5.6.7.8 01.002.0003.4 256.1.1.1",
              "4111 1111 1111 1111-2 4111-1111-1111-1111", "+1 (234) 555-0199. +12 3", "é🎈 a.b@c.de 🎈 10.0.0.1"]
    docs = docs | {-i - 1: t for i, t in enumerate(tricky)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for r in personal_data.personal_data(frame).collect():
        spans = [(k, m.start(), m.end()) for k, p in patterns.items() for m in re.finditer(p, docs[r.doc_id] or "")
                 if valid(k, m[0])]
        text = ",".join("%s:%d:%d" % s for s in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (r, text)
        assert (r.spans + ",").startswith(text + "," if text else ("", ",", "id:")), (r, text)
        n = Counter(s[0] for s in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [n[k] for k in patterns]


def test_contexts_tell_unseen_identifiers(spark):
    texts = [f"please write to user{i}@mail.org for details" for i in range(6)]
    texts += ["please write to ann(at)mail7 for details", "the year 1999 was long", "later ann(at)mail7 wrote"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in personal_data.personal_data(frame).collect()}
    assert spans[6] == "id:16:28" and spans[8] == "id:6:18" and spans[7] == ""


def test_secrets_and_what_stands_in_their_place(spark):
    """Planted secrets, unseen identifiers in their contexts, and clean texts with numbers."""
    random = np.random.default_rng(4)
    secrets = ["".join(random.choice(list("0123456789abcdef"), 40)) for _ in range(30)]
    unseen = [f"k{i}-{random.integers(1e6)}" for i in range(10)]
    def text(number, mark, secret):
        some = " ".join(random.choice(WORDS, 12))
        return f'{some} w{number} token {mark} "{secret}" {random.choice(WORDS)} {some}'

    texts = [text(i, "=", x) for i, x in enumerate([*secrets, *unseen])]
    clean = [f"{' '.join(random.choice(WORDS, 8))} x = {i} and y {1900 + i} {'b' * 40} {'7' * 40}" for i in range(40)]
    frame = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal_data.personal_data(frame).collect()}
    for i, x in enumerate([*secrets, *unseen]):
        at = texts[i].index(x)
        assert found[i] == f"id:{at}:{at + len(x)}"
    assert not any(found[i] for i in range(len(texts), len(texts) + len(clean)))
    glued = spark.createDataFrame([(1, f'key="{secrets[0]}"; {secrets[1]}z')], "doc_id long, text string")
    assert personal_data.personal_data(glued).first().spans == "id:5:45"


def test_personal_data_of_odd_rows(spark):
    found = personal_data.personal_data(odd_docs(spark)).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows())
    by_id = {r.doc_id: r for r in found if r.doc_id}
    assert by_id[2].spans == by_id[4].spans == by_id[14].spans == ""
    assert [by_id[7].n_email, by_id[7].n_ip, by_id[7].n_card] == [1, 1, 1]
    assert personal_data.personal_data(no_docs(spark)).count() == 0


# Repeated passages

def test_repeated_paragraphs_equal_brute_force(spark, docs):
    """Places, components and the occurrence that stays, from all pairs of paragraphs."""
    own = []
    for i, t in docs.items():
        at = 0
        for line in (t or "").split("\n"):
            found = tuple(WORD.findall(lower(line)))
            if len(found) >= paragraphs.PARAGRAPH_WORDS:
                own.append((i, at, found))
            at += len(found)
    own.sort()
    sets = [{w[i:i + 5] for i in range(len(w) - 4)} for _, _, w in own]
    links = [(x, y) for x in range(len(own)) for y in range(x) if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])]
    name = groups(range(len(own)), links)
    members = {}
    for x, g in name.items():
        members.setdefault(g, set()).add(own[x][0])
    expected = {(own[x][0], own[x][1], own[x][1] + len(own[x][2]), own[g][0], x == g)
                for x, g in name.items() if len(members[g]) > 1}
    found = entry.queries()["op8_repeated_paragraphs"](spark, SMALL).collect()
    assert expected and {tuple(r)[:1] + tuple(r)[2:] for r in found if r.kind == "paragraph"} == expected
    assert all(r.component_id <= r.doc_id for r in found)


def test_runs_equal_brute_force(spark):
    """Passages of several lengths in two to four documents: places, first document, the one that stays."""
    random = np.random.default_rng(29)
    make = lambda n: [f"w{x}" for x in random.integers(0, 1 << 40, n)]
    texts, at = {}, {}
    for number in range(60):
        passage = make(int(random.integers(20, 90)))
        for doc in random.choice(80, int(random.integers(2, 5)), replace=False).tolist():
            own = texts.setdefault(doc, make(40))
            at.setdefault(doc, {})[len(own)] = (len(passage), number)
            own += passage + make(40)
    first = {}
    for doc in sorted(at):
        for start in sorted(at[doc]):
            first.setdefault(at[doc][start][1], (doc, start))
    expected = {(doc, start, start + size, first[n][0], first[n] == (doc, start))
                for doc, own in at.items() for start, (size, n) in own.items()}
    frame = spark.createDataFrame([(doc, " ".join(own)) for doc, own in texts.items()], "doc_id long, text string")
    found = paragraphs.repeated_passages(frame.repartition(5)).collect()
    assert {tuple(r)[:1] + tuple(r)[2:] for r in found if r.kind == "run"} == expected


def test_bands_reach_the_recall():
    n = paragraphs.bands(0.8, 0.99, 2)
    assert 1 - (1 - 0.8 ** 2) ** n >= 0.99 > 1 - (1 - 0.8 ** 2) ** (n - 1)


def test_no_passage_inside_a_line_is_missed(spark):
    random = np.random.default_rng(13)
    make = lambda n: [f"w{x}" for x in random.integers(0, 1 << 40, n)]
    rows, places = [], {}
    for number in range(300):
        size = (20, 21, 30, 51)[number % 4]
        passage = make(size)
        for copy in range(2):
            doc, at = 2 * number + copy, 100 + (number if copy else 0)
            rows.append((doc, " ".join(make(at) + passage + make(100))))
            places[doc] = (at, at + size)
    found = paragraphs.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.start_word, r.end_word) for r in found if r.kind == "run"} == places
    assert all(r.component_id == r.doc_id // 2 * 2 and r.kept == (r.doc_id % 2 == 0) for r in found)


def test_passages_of_odd_rows(spark):
    found = paragraphs.repeated_passages(odd_docs(spark)).collect()
    assert {r.doc_id for r in found} == {1, 6, 8}
    kept = {(r.doc_id, r.kind): r.kept for r in found}
    assert kept[1, "paragraph"] and not kept[6, "paragraph"] and not kept[8, "paragraph"]
    assert paragraphs.repeated_passages(no_docs(spark)).count() == 0


# Language identification

def test_held_out_accuracy(spark):
    found = entry.queries()["op10_language_crf"](spark, "/root/testdata/sf0.01").collect()
    gold = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = [r for r in found if r.held_out and gold[r.doc_id]]
    assert len(held) > 100 and sum(r.lang_pred == gold[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_marginals_equal_enumeration():
    random = np.random.default_rng(4)
    e, t, s = random.normal(size=(7, 3)), random.normal(size=(3, 3)), random.normal(size=3)
    opens = np.array([1, 0, 0, 1, 0, 0, 0], bool)
    expected = np.zeros((7, 3))
    for path in np.ndindex(*[3] * 7):
        w = np.exp(sum(e[i, k] + (s[k] if opens[i] else t[path[i - 1], k]) for i, k in enumerate(path)))
        for i, k in enumerate(path):
            expected[i, k] += w
    expected /= expected.sum(axis=1, keepdims=True)
    assert np.allclose(language.marginals(e, opens, t, s), expected)


def test_expected_transitions_are_the_slope_of_the_partition_function():
    random = np.random.default_rng(8)
    n, k = 300, 3
    e, t, s = random.normal(size=(n, k)), random.normal(size=(k, k)), random.normal(size=k)
    opens = random.random(n) < 0.05
    opens[0] = True

    def log_sum(t):
        total, x = 0.0, None
        for i in range(n):
            if opens[i]:
                total += 0.0 if x is None else np.log(np.exp(x).sum())
                x = s + e[i]
            else:
                x = np.log(np.exp(x[:, None] + t).sum(axis=0)) + e[i]
        return total + np.log(np.exp(x).sum())

    p, pairs = language.marginals(e, opens, t, s, with_pairs=True)
    assert np.allclose(p, language.marginals(e, opens, t, s))
    for i in range(k):
        for j in range(k):
            step = np.zeros((k, k))
            step[i, j] = 1e-5
            assert np.isclose(pairs[i, j], (log_sum(t + step) - log_sum(t - step)) / 2e-5, rtol=1e-4)


def test_a_text_is_labelled_alike_alone_and_in_any_batch(monkeypatch):
    import pyarrow as pa

    random = np.random.default_rng(6)
    k = 3
    model = language.Model(["a", "b", "c"], random.normal(size=(k, language.FEATURES + k + 1)).astype(np.float32),
                           2 * random.normal(size=(k, k)), random.normal(size=k), np.zeros(1 << 20, np.int16))
    monkeypatch.setattr(language, "_PIECE", 64)
    texts = [" ".join("".join(random.choice(list("abcdefgh"), 4)) for _ in range(n)) for n in (8, 64, 1, 200, 65, 8, 63)]
    label, score = language.predict(pa.array(texts), model)
    for i, text in enumerate(texts):
        alone = language.predict(pa.array([text]), model)
        assert alone[0][0] == label[i] and np.isclose(alone[1][0], score[i])


def test_code_switched_words_are_told_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs)
    texts = [docs.filter(f"lang = '{k}' and n_chars between 500 and 3000").orderBy("doc_id").first().text
             for k in ("de", "es")]
    import pyarrow as pa

    label, score = language.predict(pa.array([texts[0], texts[1], texts[0] + " " + texts[1]]), model)
    assert [model.labels[k] for k in label[:2]] == ["de", "es"]
    assert score[2] < 0.9 < min(score[:2])


def test_languages_of_odd_rows(spark):
    docs = odd_docs(spark)
    found = language.identified(docs, language.fit(docs), "doc_id").collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows())
    by_id = {r.doc_id: r for r in found if r.doc_id}
    for i in (2, 3, 5, 13):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[9].lang_pred in ("en", "es") and by_id[1].lang_pred != "und"
    kept = language.with_a_language(docs)
    assert kept.columns == docs.columns and not {2, 3, 5, 13} & {r.doc_id for r in kept.collect()}
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang")
    assert {r.lang_pred for r in language.identified(unlabelled, language.fit(unlabelled), "doc_id").collect()} == {"und"}
    assert language.with_a_language(no_docs(spark)).count() == 0


# Mixing

def check_mixture(found, most=3):
    by_source = {}
    for r in found:
        by_source.setdefault(r.source, []).append(r)
    for own in by_source.values():
        largest = max(r.size for r in own)
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= largest
        rate = own[0].target / own[0].source_size if own[0].source_size else 0
        assert all(r.copies in (int(rate + 1e-9), int(rate + 1e-9) + 1) and r.copies <= most for r in own)


def test_mixture_meets_its_targets(spark):
    sizes = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        "source", mixing.words_of().alias("size")).selectExpr("monotonically_increasing_id() as key", "*")
    found = mixing.mixed_copies(sizes).collect()
    assert len(found) == 1000
    check_mixture(found)
    assert sum({r.source: r.target for r in found}.values()) == pytest.approx(sum(r.size for r in found))
    again = mixing.mixed_copies(sizes.repartition(5)).collect()
    assert sorted((r.key, r.copies) for r in again) == sorted((r.key, r.copies) for r in found)


def test_many_units_fold_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 8)
    sizes = spark.range(3000).selectExpr("id as key", "if(id % 3 = 0, null, concat('s', id % 2)) as source",
                                         "id % 17 as size")
    found = mixing.mixed_copies(sizes).collect()
    assert len(found) == 3000
    check_mixture(found)


def test_targets_stop_and_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 5)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a stops at 30; the null source weighs 5 again and stops at 15; b and c share the rest 2 : 1.
    assert got == pytest.approx({"a": 30.0, None: 15.0, "b": 170 * 2 / 3, "c": 170 / 3})


def half_equal(spark, n=24_000):
    """Half of the rows are equal in everything, without an id."""
    own = F.when(F.col("i") % 2 == 0, F.col("i"))
    return spark.range(n).withColumnRenamed("id", "i").select(
        own.alias("doc_id"), F.when(own.isNull(), "a b c").otherwise(F.concat_ws(" ", own, F.lit("x y z w")))
        .alias("text"), F.when(F.col("i") % 6 == 0, "s1").otherwise("s0").alias("source")).repartition(5)


def test_equal_units_spread_over_blocks(spark):
    docs = half_equal(spark)
    sizes = docs.select(F.col("doc_id").alias("key"), "source", mixing.words_of().alias("size"))
    units = mixing._units(sizes, mixing.SEED)
    count = Counter(r.source for r in sizes.collect())
    blocks = Counter()
    for r in units.collect():
        place = (r._h % (1 << 64) >> 11) / (1 << 53)
        blocks[r.source, int(place * -(-count[r.source] // mixing.FAN_IN))] += 1
    assert max(blocks.values()) <= 2 * mixing.FAN_IN
    found = mixing.mixed_copies(sizes).collect()
    assert len(found) == 24_000
    check_mixture(found)
    again = mixing.mixed_copies(sizes.repartition(3)).collect()
    assert Counter(found) == Counter(again)


def test_equal_rows_spread_over_cells(spark):
    docs = half_equal(spark)
    hashes = Counter(r._h for r in sharding._hashed(docs, sharding.SEED).select("_h").collect())
    assert max(hashes.values()) == 1 and len(hashes) == 24_000
    found, again = (sharding.interleaved_shards(x).collect() for x in (docs, docs.repartition(3)))
    assert Counter(found) == Counter(again)
    assert set(Counter(r.shard for r in found).values()) == {1500}
    few = spark.createDataFrame([(7, f"t{i % 3}", None) for i in range(100)], "doc_id long, text string, source string")
    assert Counter(r.text_crc32 for r in sharding.interleaved_shards(few).collect()).most_common()[0][1] == 34


def test_mixing_odd_rows(spark):
    docs = odd_docs(spark)
    taken = mixing.mixed(docs)
    assert taken.columns == docs.columns
    assert {r.doc_id for r in taken.collect()} <= {r[0] for r in rows()}
    assert mixing.mixed(no_docs(spark)).count() == 0


# Sharding

def test_shards_of_odd_rows(spark):
    found = sharding.interleaved_shards(odd_docs(spark), n_shards=4).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows())
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1 and all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_id = {r.doc_id: r for r in found}
    assert (by_id[2].size, by_id[2].text_crc32, by_id[3].size) == (1, 0, 1) and by_id[4].size == len(LONG) + 1
    assert sharding.interleaved_shards(no_docs(spark)).count() == 0


def test_shards_hold_the_mixture(spark):
    found = sharding.interleaved_shards(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    total = Counter(r.source for r in found)
    for shard in range(16):
        own = Counter(r.source for r in found if r.shard == shard)
        assert all(abs(own[s] - n / 16) <= 2 for s, n in total.items())


def test_filters_of_few_keys_are_small_for_the_driver(spark):
    """Keys once, twice by one unit and twice by two; the driver holds no more than what they need."""
    def keyed(batch):
        n = batch.column("id").to_numpy().astype(np.uint64)
        key = (n % np.uint64(300) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        turn = n // np.uint64(300)
        keep = (turn == 0) | (n % np.uint64(300) >= 100)
        unit = np.where(n % np.uint64(300) >= 200, key + turn, key)
        yield key[keep], unit[keep]

    repeated, several = buckets.shared_keys(spark.range(0, 600, 1, 4), keyed)
    assert len(cloudpickle.dumps((repeated, several))) < 1 << 20
    keys = (np.arange(300, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for _ in range(2):
        assert repeated.holds(keys).tolist() == [False] * 100 + [True] * 200
        assert several.holds(keys).tolist() == [False] * 200 + [True] * 100
        assert cloudpickle.loads(cloudpickle.dumps(several)).holds(keys).tolist() == several.holds(keys).tolist()
    assert not buckets.shared_keys(spark.range(0), keyed)[0].holds(keys).any()
