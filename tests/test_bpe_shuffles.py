from corpusloom.functions import bpe


def test_no_word_is_shuffled(spark, monkeypatch):
    """Texts are counted where they are read, those that share words with others too."""
    stage, plans = bpe.stage_table, []

    def staged(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(bpe, "stage_table", staged)
    monkeypatch.setattr(bpe, "KNOWN", 2)
    ranks = {b"a": 0, b"b": 1, b"ab": 2, b" ab": 3, b" ": 4, b" a": 5}
    rows = [(i, [None, "", "ab ab", "abab a", "b" * 100][i % 5]) for i in range(300)]
    got = {r.chunk_id: r.tokens for r in bpe.token_counts(spark.createDataFrame(rows, "chunk_id long, text string"), ranks).collect()}
    assert got == {i: [0, 0, 2, 3, 100][i % 5] for i in range(300)}
    assert plans and not any("Exchange" in p for p in plans)
