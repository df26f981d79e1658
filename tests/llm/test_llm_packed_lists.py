"""Lists of ids at the longest length, and how they are stored."""

from pyspark.sql import functions as F
from tickfold.llm import best_fit as module
from tickfold.llm.best_fit import pack_tokens


def test_lists_about_the_longest_length(spark, monkeypatch):
    seen = []
    keep = module.written

    def written(df, name):
        seen.append(set(df.columns))
        return keep(df, name)

    monkeypatch.setattr(module, "written", written)
    sizes = {1: 7, 2: 8, 3: 9, 4: 16, 5: 17, 6: 0}
    df = spark.createDataFrame([(i, list(range(n))) for i, n in sizes.items()], "doc_id long, ids array<int>")
    out = pack_tokens(df, (4, 8)).orderBy("doc_id", "piece").collect()
    assert "n_tokens" in seen[0]  # counts are read without the ids
    for i, n in sizes.items():
        mine = [r for r in out if r.doc_id == i]
        assert [r.n_tokens for r in mine] == [8] * (n // 8) + [n % 8] * (n % 8 > 0 or n == 0)
        assert [t for r in mine for t in r.ids] == list(range(n))
        assert [r.first_token for r in mine] == [8 * k for k in range(len(mine))]
        assert all(len(r.ids) == r.n_tokens and r.capacity in (4, 8) for r in mine)
    assert pack_tokens(df.where(F.col("doc_id") < 0)).collect() == []
