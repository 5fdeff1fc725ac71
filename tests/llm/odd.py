"""Hand-written rows that every operator must take: nulls, empty, long, repeated, clashing names."""

COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, _row long, size long, "
           "component string, score double, unit string, key string, words string, copies int, n long")

GNU = "This program is released under the GNU General Public License."
WORDS = ("the cat sat on the mat while rain fell over green hills and old men spoke of ships that left "
         "the harbour long before any of them could walk or read a map of stars").split()
PASSAGE = " ".join(WORDS)
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))


def rows():
    texts = [
        (1, f"{PASSAGE}\n{GNU}"), (1, f"{PASSAGE}\n{GNU}"), (2, None), (3, ""), (4, LONG), (5, " \n\t!?. "),
        (6, f"{PASSAGE}\n{GNU}"), (None, "mail me at jo.doe@example.org or +1 (234) 555-0199"), (None, None),
        (7, "mail me at jo.doe@example.org or 4111 1111 1111 1111 and 10.0.0.256 and 10.0.0.25"),
        (8, f"Prefix here {PASSAGE} and a tail"), (9, "único niño árbol über straße ÉTÉ"),
        (10, "a"), (11, "MIT license mit LICENSE cc-by cc by"), (12, "x" * 50_000), (13, "1" * 30_000),
        (14, "a" * 20_000 + "@"), (15, "\n".join(["same line of words"] * 50)),
    ]
    out = []
    for i, (doc_id, text) in enumerate(texts):
        lang = None if i % 5 == 4 else ("en" if i % 2 else "es")
        source = None if i % 4 == 3 else f"s{i % 3}"
        out.append((doc_id, text, lang, source, i, 7, None, "c", 0.5, "u", "k", "w", 3, None))
    return out


def odd_docs(spark):
    return spark.createDataFrame(rows(), COLUMNS)


def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


def benchmark(spark):
    return spark.createDataFrame(
        [(1, PASSAGE), (2, None), (3, ""), (None, PASSAGE), (4, "too short"), (1, PASSAGE)],
        "item_id long, text string")
