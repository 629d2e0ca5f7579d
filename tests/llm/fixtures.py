"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, "
    "n_words int, component_id string, line_dedup int, n string, doc string, label int"
)


def words(seed, n, letters="abcdefghijklmnop"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def texts():
    base = words(1, 120)
    parts = base.split(" ")
    near = " ".join([*parts[:60], "changed", *parts[61:]])
    far = " ".join([*parts[:40], *words(2, 80).split(" ")])
    passage = words(3, 30)
    line = "A line that several documents hold"
    return [
        (1, base),
        (2, near),
        (3, base),
        (4, far),
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, "word"),
        (9, "two words"),
        (10, f"{line}\n{words(4, 30)}\n\n  {line.upper()}  \nshort"),
        (11, f"{words(5, 25)}\n{line}\r\n{words(6, 20)}"),
        (12, passage + " " + words(7, 50)),
        (13, words(8, 40) + " " + passage),
        (14, "la " * 3000),
        (15, words(9, 20000)),
        (16, "Ünïcödé «ç» 日本語 テキスト 😀 don't  x \x1c y\xa0z"),
        (16, "Ünïcödé «ç» 日本語 テキスト 😀 don't  x \x1c y\xa0z"),
        (17, words(10, 60) + "\n" + "same sentence again and over here now " * 6),
        (18, "#hash *star* $5 |pipe| <a&b> 100%"),
        (None, words(11, 30)),
        (19, "é" * 150 + words(12, 3) + "é" * 150),
        (20, "<|endoftext|> 'll we've\n\n\n  indented   text\t\ttabs "),
    ]


def rows():
    return [
        (i, t, "en", None if i == 4 else f"s{(i or 0) % 3}", None if t is None else len(t), 0.5, "x", 7, "c", 1, "n", "d", 0)
        for i, t in texts()
    ]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
