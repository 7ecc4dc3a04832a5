"""Small documents with every awkward case, and a table whose extra columns clash with the operators' own."""

import random

BLANK = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return text.translate(LOWER)


def documents(seed=1, n=80):
    """(doc_id, text) with nulls, empty texts, exact and near copies, repeated lines, very long texts, odd characters."""
    rnd = random.Random(seed)
    words = ["alpha", "Beta", "gamma", "délta", "eps1lon", "zeta", "日本", "x", "longer-word", "theta", "iota", "KAPPA"]
    line = "This common line is certainly longer than forty characters."
    out = []
    for i in range(n):
        body = " ".join(rnd.choice(words) + str(rnd.randint(0, 30)) for _ in range(rnd.randint(1, 120)))
        if i % 4 == 0:
            body += "\n" + (line if i % 8 else "  " + line.upper() + " \t")
        if i % 9 == 0:
            body += "\n\n" + line + "\n" + line
        out.append((i, body))
    base = " ".join(f"w{rnd.randint(0, 500)}" for _ in range(150))
    for i in range(n, n + 24):  # a group of near copies, some beyond the threshold
        w = base.split()
        for _ in range(i % 7):
            w[rnd.randrange(len(w))] = f"changed{rnd.randint(0, 10**6)}"
        out.append((i, " ".join(w)))
    out += [(n + 30, out[3][1]), (n + 31, out[3][1].replace(" ", " \t\n ")), (n + 32, None), (n + 33, ""), (n + 34, " \n "),
            (n + 35, None), (n + 36, "one"), (n + 37, "ONE"), (n + 38, "a b c d"), (n + 39, "long " * 30000), (n + 40, "y" * 70000)]
    return out


def frame(spark, rows=None, extra=False):
    df = spark.createDataFrame(documents() if rows is None else rows, "doc_id long, text string")
    if not extra:
        return df
    names = ["score", "maybe", "text_sha256", "n_lines", "kept_text", "kept", "maybe_gone", "n_values", "component_id", "node", "h",
             "_found", "key", "lang", "Text_SHA256_"]
    return df.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
