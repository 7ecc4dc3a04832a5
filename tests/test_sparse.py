import hashlib
import re
from collections import Counter

import workload.all  # noqa: F401
from workload.registry import QUERIES


def terms(text):
    return Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in re.split("[^a-z0-9]+", text.lower()) if t)


def test_postings_search_scores_all_entries_of_rows_and_queries(spark, folder):
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    texts = {i: " ".join(w for n, w in enumerate(words) for _ in range((i * 7 + n * 3) % 5)) for i in range(40)}
    items = {1: "alpha beta beta gamma gamma kappa", 2: "zeta eta theta iota iota", 3: "nowhere delta"}
    spark.createDataFrame([(i, t, "en", "a") for i, t in texts.items()], "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = set()
    for q, item in items.items():
        asked = terms(item)
        scores = [(-sum(v * asked[d] for d, v in terms(t).items()), i) for i, t in texts.items() if asked.keys() & terms(t).keys()]
        want |= {(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:10], 1)}
    found = {(r.qid, r["rank"], r.doc_id, r.score) for r in QUERIES["sparse_postings_search"](spark, folder).collect()}
    assert found == want and len(want) == 30
