"""Small documents with every awkward case."""

TOKENIZER = None


def tokenizer():
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


PROSE = [
    "The river ran past the old mill and over the stones. Nobody had seen the miller for days. A boat lay on its side.",
    "Quarterly figures were better than anyone had hoped, and the board agreed to a small rise in wages next spring.",
    "She wrote about birds: their calls, their nests, and the long way they travel each year. Her notes fill nine books.",
    "Größe und Gewicht hängen zusammen, aber nicht immer so, wie man denkt. 😀 Zum Beispiel bei Vögeln.",
    "Ça va très bien. Les élèves ont fini leurs devoirs avant midi, puis ils sont partis à la plage.",
]
LONG = " ".join(f"{p} Number {k} of many." for k, p in enumerate(PROSE * 400))

ROWS = [
    (0, PROSE[0], "en", "a", 1), (1, PROSE[1], "en", "a", 1), (2, PROSE[2], "en", "b", 1), (3, PROSE[3], "de", "b", 1), (4, PROSE[4], "fr", None, 1),
    (5, None, "en", "a", None), (6, "", "en", "a", 0), (7, " \n\t ", None, None, 3), (8, PROSE[0], "en", "c", 1), (9, PROSE[1] + " Really.", "en", "c", 1),
    (10, LONG, "en", "a", 1), (11, "junk### &&& ||| $$$ !!! " * 30, "en", "z", 1), (12, "again and again\n" * 40, "en", "z", 1), (13, "<|endoftext|> tail", "en", "z", 1),
    (1, PROSE[1], "en", "a", 1), (1, PROSE[1], "en", "a", 1), (None, PROSE[2], "en", "a", 1), (14, "a" * 20000, "en", "a", 1), (15, "x  y   z\r\n\n w v\x00u", "en", "a", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = ["key", "h", "cls", "grp", "row", "score", "x", "sig", "first", "last", "n", "label", "media", "words", "_found", "_features", "_covered", "_clean", "_id", "_key", "_document_key"]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit("own " + c) for c in CLASHING})


def labels(spark, rows=((0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 1, 0), (11, 0, 0), (12, 0, 0), (None, 1, 0), (13, None, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def as_set(df):
    return sorted(map(repr, df.collect()))
