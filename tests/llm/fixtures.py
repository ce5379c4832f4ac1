"""Small document tables with every awkward case, for brute-force comparisons."""

from __future__ import annotations

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    parts = ["an", "be", "cor", "den", "él", "fu", "gim", "ho", "ist", "ñu"]
    return [
        "".join(parts[int(c)] for c in str(draw.randrange(vocabulary))) for _ in range(n)
    ]


def awkward_texts() -> list[str | None]:
    """Null, empty, white space, special strings, rare characters, controls, very long."""
    return [
        None,
        "",
        " ",
        "\n\n \t x",
        "it's we'll  don't  2024½ a_b--c!!",
        "before <|endoftext|> after<|startoftext|>",
        "日本語 текст ελληνικά Σ ΟΔΟΣ 🙂 naïve",
        "a\u00a0b\u0085c\x1cd\x00e İstanbul ŉ ǅ ﬁ e\u0301",
        " ".join(words(1, 3000)),
        "x" * 5000,
        " ".join(words(1, 3000)),
    ]


def documents(spark, texts, first_id: int = 0):
    rows = [(first_id + i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA)
