"""New prompts by seeded weighted choice from word lists, without near copies of what is there."""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

ATTEMPTS_EACH = 60
LIKE = 0.85


def _tokens(line: str) -> frozenset[str]:
    return frozenset(line.lower().replace(",", " ").split())


def _candidates(rng: random.Random, words: dict) -> Iterator[tuple[str, str]]:
    """(style group, line) without end: three shapes of sentence over the category's words."""
    groups = sorted(words["styles"])
    while True:
        group = rng.choices(groups, [words["weights"].get(g, 0.0) for g in groups])[0]
        part = {k: rng.choice(words[k]) for k in ("tones", "characters", "decays", "processing")}
        style, noun = rng.choice(words["styles"][group]), words["noun"] + (" one shot, single note" if words["pitched"] else " one shot")
        shape = rng.randrange(3)
        if shape == 0:
            head, tail = f"{style} {part['tones']} {noun}", [part["characters"], part["decays"], "dry"]
        elif shape == 1:
            head, tail = f"{part['tones']} {noun}", [f"{style} character", part["characters"], part["processing"]]
        else:
            head, tail = f"{style} {noun}", [part["characters"], part["decays"], part["processing"]]
        yield group, ", ".join([head, *tail, words["excluded"], "no loop"])


def authored(wanted: DataFrame, words: dict[str, dict], seed: str = "tessera") -> DataFrame:
    """(category, place, style, prompt) for rows (category, need, existing array of prompts).

    Each category draws from its own generator, so its lines do not depend on other categories. A line that is like an
    existing or an earlier new one is passed over; after ATTEMPTS_EACH draws for each line needed the list ends short.
    One category's prompts are a few hundred lines by design, which is what one task holds.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        category, need = row["category"], int(row["need"])
        held = [_tokens(x) for x in ([] if row["existing"] is None else row["existing"])]
        out: list[tuple[str, int, str, str]] = []
        source = _candidates(random.Random(f"{seed}:{category}"), words[category])
        for _ in range(ATTEMPTS_EACH * need):
            if len(out) >= need:
                break
            group, line = next(source)
            mine = _tokens(line)
            if all(len(mine & x) < LIKE * len(mine | x) for x in held):
                held.append(mine)
                out.append((category, len(out) + 1, group, line))
        return pd.DataFrame(out, columns=["category", "place", "style", "prompt"])

    return wanted.groupBy("category").applyInPandas(run, "category string, place int, style string, prompt string")
