"""Small inputs that hold the awkward cases, and plain-Python twins."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, winner string, copies int, __key long"


def documents(seed: int = 1, n: int = 60) -> list[tuple[int, str | None]]:
    """Prose with copies, near copies, shared passages, null, empty and blank texts, and one long text."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice(["th", "er", "on", "an", "re", "é", "ß", "St", "ing"]) for _ in range(rnd.randint(1, 3))) for _ in range(120)]
    word = lambda: rnd.choice(vocabulary) + rnd.choice(["", "", "", ".", ","])
    texts: list[str | None] = [None, "", "   ", "\n", "One", "one  ", "ONE", "Ünï ünï", None]
    passage = " ".join(word() for _ in range(40))
    for _ in range(n):
        texts.append(" ".join(word() for _ in range(rnd.randint(1, 90))))
    base = " ".join(word() for _ in range(120))
    for _ in range(6):
        w = base.split()
        w[rnd.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += [base, base, base.replace(" ", "  "), base + "\n", f"{texts[20]} {passage} {texts[21]}", f"{passage}\t{texts[22]}", passage, " ".join(word() for _ in range(6000))]
    rnd.shuffle(texts)
    return list(enumerate(texts, 3))


def frame(spark, rows):
    """Rows as a documents table, with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t), "x", 1, 7) for i, t in rows], SCHEMA).repartition(3)
