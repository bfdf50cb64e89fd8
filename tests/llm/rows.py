"""Small document tables with the awkward rows every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6))) for _ in range(n)]
    return " ".join(words)


def edge_rows() -> list[tuple]:
    rng = random.Random(5)
    base = [prose(rng, n) for n in (3, 60, 80, 120, 400)]
    near = base[3].split()
    near[60] = "changed"
    shared = "This very line is held by many documents."
    rows = [
        (1, base[0], "en", "a", 1), (2, base[1], "en", "a", 1), (3, base[2], "de", "b", 1),
        (4, base[3], "en", None, 1), (5, base[3], None, "b", None), (6, " ".join(near), "en", "a", 1),
        (7, None, "en", "a", 0), (8, "", "en", "b", 0), (9, " \n\t ", None, None, 0),
        (None, base[4], "en", "a", 1), (None, None, None, None, None), (None, "nothing like it", "en", "a", 1),
        (None, "nor like this one", "en", "a", 1),
        (10, base[4], "en", "c", 1), (10, base[4], "en", "c", 1),          # a repeated row
        (11, "one two", "en", "c", 1), (12, "ONE  Two", "en", "c", 1), (13, "two one", "en", "c", 1),
        (14, (base[1] + " ") * 3, "en", "a", 1), (15, "###$$$ " * 70 + base[2], "en", "a", 1),
        (16, base[0] + "\n" + base[0] + "\n\n" + base[0], "en", "b", 1),
        (17, " ".join(prose(rng, 20) for _ in range(2000)), "en", "a", 1),     # 40,000 words
        (20, shared, "en", "a", 1), (21, f"  {shared.upper()}\t\nkept", "en", "a", 1),
        (22, f"{shared}\nx\n{shared}", "en", "b", 1), (23, f"start\r\n{shared}", "en", "b", 1),
    ]
    return rows


def documents(spark, rows=None, extra: bool = False):
    df = spark.createDataFrame(edge_rows() if rows is None else rows, SCHEMA)
    if extra:       # names that operators add themselves
        for c in ("size", "taken", "kept", "n_words", "score", "piece", "offset", "component_id", "node", "keep",
                  "slot", "shard", "n_lines", "base_failed", "draws", "predicted", "law"):
            df = df.selectExpr("*", f"'clash' as {c}")
    return df
