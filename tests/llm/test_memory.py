from corpusloom.llm import toxicity as T

WORDS = [a + b + c for a in ("idio", "moro", "disgust", "scu", "plain", "réeu") for b in ("t", "n", "ing", "m", "x", "") for c in ("", "s", "zz")]
TERMS = {"idiot": 5.0, "moron": 5.0, "disgusting": 5.0, "scum": 5.0, "réeux*": 4.0}


def test_states_are_kept_once_and_forgotten(monkeypatch):
    auto = T.Automaton(TERMS)
    want = {w: hit for w in WORDS if (hit := auto.match(w))}
    assert auto.known(set(WORDS)) == want and auto.known(set(WORDS)) == want and len(want) > 5
    assert len(set(auto.sets)) == len(auto.sets) < auto.made
    monkeypatch.setattr(T, "KEPT_MOVES", 10), monkeypatch.setattr(T, "KEPT_WORDS", 5), monkeypatch.setattr(T, "KEPT_LETTERS", 6)
    small = T.Automaton(TERMS)
    for w in WORDS:
        assert small.known({w}) == ({w: want[w]} if w in want else {})
        assert small.made <= 10 + len(w) and len(small.some) + len(small.none) <= 5


def test_pipeline_takes_documents_in_small_batches(spark):
    import corpus_pipeline as P

    key, sf = "spark.sql.execution.arrow.maxRecordsPerBatch", "/root/testdata/sf0.001"
    before = spark.conf.get(key)
    try:
        for value, want in (("10000", P.BATCH_ROWS), ("0", P.BATCH_ROWS), ("100", 100)):
            spark.conf.set(key, value)
            P.encode(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
            assert int(spark.conf.get(key)) == want
    finally:
        spark.conf.set(key, before)
