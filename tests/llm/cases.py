"""Documents with every awkward case, and plain references to check against."""

import re

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
CLASHING = "doc_id long, text string, source string, row string, KEY string, uid long, N_Words string, kept string, state string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def awkward_texts():
    """(doc_id, text): nulls in any column, empty, blank, very long and repeated texts, equal rows."""
    prose = " ".join(f"word{i % 97} and {i * 7 % 31}" for i in range(300))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "### $$$ !!!"),
        (5, prose),
        (5, prose),
        (6, prose.upper()),
        (7, prose + " tail"),
        (None, "one two three"),
        (None, None),
        (8, "\u00e9t\u00e9 \u4e2d\u6587 \U0001f600 mixed TEXT\r\nline"),
        (9, "same line\nsame line\n\n same line\nother"),
        (10, " ".join(f"w{i * i % 50021}" for i in range(60_000))),
        (11, "x" * 200_000),
    ]


def documents(spark, rows=None):
    """The cases as a frame whose extra columns clash with the operators' own names."""
    rows = awkward_texts() if rows is None else rows
    full = [(i, t, None if n % 4 == 0 else f"host{n % 3}", "r", "k", n, "nw", "kp", "st") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, CLASHING)


def edit_distance(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        current = [i]
        for j, y in enumerate(b, 1):
            current.append(min(previous[j] + 1, current[-1] + 1, previous[j - 1] + (x != y)))
        previous = current
    return previous[-1]


def roots(n, edges):
    """The smallest member of each number's component."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]
