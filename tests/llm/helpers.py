"""Small corpora with every kind of odd row, and the brute-force versions the operators are held against."""

import random

SYLLABLES = "an the ing ou re st ion ed ha li mo nu ka ver ge cht sch ée ño ß".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(seed=1, size=60):
    """Prose, copies, near copies, shared lines, empty, missing and long texts, missing ids and sources, repeated rows."""
    rng = random.Random(seed)
    shared = "This line of some length is shared by a number of documents here."
    rows = []
    for i in range(size):
        lines = [prose(rng, rng.randint(3, 30)) for _ in range(rng.randint(1, 5))]
        if i % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), f"  {shared.upper() if i % 8 else shared}\t")
        rows.append((i, "\n".join(lines), "en", f"src{i % 5}", 0))
    rows += [(100 + k, rows[3][1], "en", "src0", 0) for k in range(20)]  # a large group of copies
    rows += [(130 + k, rows[5][1] + f" tail{k}", "de", "src1", 0) for k in range(5)]
    rows += [(140, None, None, None, None), (141, "", "en", None, 0), (142, " \t\n ", "fr", "", 0), (143, "one", "fr", "", 3)]
    rows += [(150, prose(rng, 9000), "en", "src0", 0), (151, "x" * 60000, "en", "src0", 0), (152, "1 " * 30000, "en", "src1", 0)]
    rows += [(None, "text without a number", "en", "src0", 0), (None, None, "en", "src0", 0)]
    rows += [rows[7], rows[7], (7, "another text under the same number", "en", "src2", 0)]
    return rows


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def clashing(df, *names):
    """The frame with more columns, under names that operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(n) for n in names})


class Components:
    def __init__(self):
        self.parent = {}

    def find(self, a):
        self.parent.setdefault(a, a)
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
