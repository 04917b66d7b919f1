"""Documents for the operator tests: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCAB = {
    "en": "the of and with that from this have which their would about there could other after first water people little".split(),
    "de": "der die und das nicht eine für über können würde häufig straße größe zwischen während schön über müssen einfach".split(),
}


def prose(rng, n, lang="en"):
    return " ".join(rng.choice(VOCAB[lang]) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


def corpus(n=60, seed=1):
    """(doc_id, text, lang, source, n_chars) rows with every awkward case."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = "de" if i % 3 == 0 else "en"
        t = prose(rng, rng.randint(20, 200), lang)
        rows.append((i, t, lang, f"src{min(i % 5, 2)}", len(t)))
    t = rows[4][1]
    rows += [
        (100, t, "en", "src0", 1), (101, t + " tail", "en", "src1", 1), (102, t.upper(), None, "src1", None),
        (103, None, "en", "src0", 0), (104, "", "en", None, 0), (105, " \n\t ", "de", "src2", 4), (106, "12 34 !!", "en", "src2", 8),
        (107, "one two", "en", "src9", 7), (107, "one two", "en", "src9", 7), (None, prose(rng, 40), "en", "src1", 9), (None, None, None, None, None),
        (108, "x" * 30000, "en", "src0", 1), (109, (prose(rng, 30) + "\n") * 300, "en", "src0", 1),
        (110, "a b c\n" * 40, "en", "src0", 1), (111, "é😀 word. é😀 word. é😀 word.", "en", "src0", 1),
    ]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def clash(df):
    """The same documents with extra columns named like those an operator adds."""
    from pyspark.sql import functions as F
    names = ("score", "shard", "slot", "virtual_slot", "kept", "spans", "base", "items", "n_words", "size", "x", "bin", "part",
             "extra", "taken", "times", "target", "lang_pred", "predicted", "n_hit", "removed", "class", "bands", "_s", "checksum",
             "_d", "_t", "_host", "_sum", "_at", "_words", "_lang", "_hit", "_text", "_row", "_marked", "_chunks", "_lines", "_removed",
             "_cut", "_chars", "_ends", "_ranges", "_copy", "bucket", "bitmap", "key", "host", "source_size", "proposals", "virtual_slot", "base_failed")
    return df.withColumns({n: F.lit("mine") for n in names})
