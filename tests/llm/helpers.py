import random
import re

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
#: Columns that documents may have besides; their names clash with names inside the operators.
CLASH = "component_id long, kept boolean, hi string, bands int, place string, bucket string, copies string, rank string, size string, score string, n_units string, `marked doc` long"


def sentence(rng, n=12):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(n)).capitalize() + "."


def text(seed, sentences=12):
    rng = random.Random(seed)
    return "\n".join(" ".join(sentence(rng) for _ in range(3)) for _ in range(sentences // 3))


def edited(t, seed, share):
    rng = random.Random(seed)
    return " ".join("edit%d" % rng.randrange(10**6) if rng.random() < share else w for w in t.split(" "))


def awkward():
    """(doc_id, text): nulls, empty texts, blanks, a long text, repeated rows, copies, near copies."""
    base, long = text(1), text(2, 3000)
    near = [(20 + i, edited(base, i, s)) for i, s in enumerate((0.01, 0.02, 0.05, 0.1, 0.2, 0.03, 0.01))]
    return [(1, base), (2, None), (3, ""), (4, " \t\n "), (5, long), (6, base), (6, base), (7, "one"), (8, "ONE"), (9, "Größe 東京 \U0001f600 \r\n x"), (10, long + " tail"), (None, text(3)), *near, *((40 + i, text(50 + i)) for i in range(6))]


def frame(spark, rows, clash=False):
    if not clash:
        return spark.createDataFrame(rows, "doc_id long, text string")
    return spark.createDataFrame([(*r, *[None] * len(re.sub("`.*?`", "x", CLASH).split(","))) for r in rows], "doc_id long, text string, " + CLASH)
