"""Small frames with the awkward cases, and brute-force versions."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

PROSE = ("The river ran past the old mill and the children threw small flat stones across it until the evening bell rang "
         "from the tower on the hill and every one of them went home for supper with wet feet and happy faces")

#: (doc_id, text): null, empty and blank texts, a null id, repeated rows, ties, a very long text, odd characters.
AWKWARD = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (5, " \n\t "), (None, PROSE), (6, "one"), (7, "one"),
    (8, "a  b\n\nc ▁ d\r\n<|endoftext|> <s> 日本語 é \x00 x"), (9, "word " * 60), (10, "x" * 30_000),
    (11, " ".join(f"w{i}" for i in range(20_000))), (12, PROSE.replace("evening", "morning")), (13, "A|B|C $$ ** " * 30),
]


def docs(spark, rows=AWKWARD):
    """The rows with further columns, named like the operators' own results."""
    wide = [(i, t, None, "src", 7, True, 0.5) for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, n_tokens long, source string, component_id long, kept boolean, score double")


def empty(spark):
    return docs(spark, [])


def words(text):
    return WORD.findall(text or "")


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()


def roots(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def measures(text):
    w, seen, dup, lines = words(text), set(), 0, 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + o for i, x in enumerate(windows) if often[x] > 1 for o in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), lines)
