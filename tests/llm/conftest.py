"""Documents with every odd case: nulls, empty and very long texts, ties, repeated
rows, strange characters, and extra columns that clash with the operators' own names."""

import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, chunk long, size string, name string, "
          "uid string, id string, kept string, score string, number string")


def odd_texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 7)))
    texts = [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(40)]
    long = " ".join(word() for _ in range(9000)) + "\n" + "x" * 30_000 + "   " * 900 + "7" * 5000
    return [*texts, None, "", " \t\n", "one", "One  two\tthree", "one two three", "one two three", "One two three", long, long,
            texts[0], texts[0] + " tail", "a<|endoftext|>b <|endoftext|>", "nbsp and\x85and\x1cand and 　 漢字 😀 שלום é",
            "it's 12 o'clock, we'll  go!\r\n\r\n  don't", "A" * 200, "é" * 9000, "\x00 zero \x00", " lead and trail "]


@pytest.fixture(scope="session")
def odd_rows():
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t or ""), 1, "x", "y", "z", "w", "k", "s", "n")
            for i, t in enumerate(odd_texts())]
    rows.append(rows[0])                                # a repeated row
    rows.append((None, "no id here at all", *rows[0][2:]))
    rows.append((None, None, None, None, None, None, None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
