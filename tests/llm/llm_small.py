"""Small documents with every awkward case."""

import random

SF_DIR = "/root/testdata/sf0.001"
# names that operators use for themselves or return
CLASHING = ["kept", "score", "length", "key", "rep", "n", "shard", "spans", "place", "root", "label"]


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
                    for _ in range(n))


AWKWARD = [
    (1, sentence(1, 40)), (1, sentence(1, 40)),       # a repeated row
    (2, sentence(1, 40)),                             # a copy
    (3, None), (4, ""), (5, " \n\t "),
    (6, "one"), (7, "one"), (None, sentence(2, 30)), (None, None),
    (8, sentence(3, 30_000)), (9, "x" * 50_000), (10, "Ünïcödé ß 漢字 😀   \x1c <|endoftext|>"),
    (-5, sentence(4, 12)), (2 ** 62, sentence(5, 2000)),
]
