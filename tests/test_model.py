"""Rating model: seeded training, tree mean equals the forest, unseen labels use code 0."""

from pyspark.sql import functions as F

from venuelens.operators import rating_model as M


def test_forest_and_interval(spark, tables):
    lst = tables.listing()
    model, metrics = M.train_rating_model(lst, trees=10, max_depth=8)
    m = metrics.first()
    assert m.n_samples > 20 and m.rmse is not None
    req = lst.select("listing_id", "category", "area", "price").limit(50)
    pred = {r.listing_id: r.predicted_rating for r in M.predict_rating(model, req).collect()}
    inter = {r.listing_id: r for r in M.prediction_interval(model, req).collect()}
    for k, p in pred.items():
        assert inter[k].predicted_rating == p             # mean of the trees = forest prediction
        assert 1.0 <= inter[k].low <= p <= inter[k].high <= 5.0
    unseen = spark.createDataFrame([(1, "NEVER-SEEN", "Brand#1", 100.0)], "listing_id long, category string, "
                                                                       "area string, price double")
    first = sorted(r.category for r in lst.select("category").distinct().collect())[0]
    seen = unseen.withColumn("category", F.lit(first))
    assert M.predict_rating(model, unseen).first().predicted_rating == \
        M.predict_rating(model, seen).first().predicted_rating     # Q20


def test_trees_stay_tables_and_cells_agree_with_their_nodes(spark, tables):
    lst = tables.listing()
    model, metrics = M.train_rating_model(lst, trees=5, max_depth=6)
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}      # rows written by tasks: the driver grows no tree
    assert {t for t, _ in nodes} == set(range(5)) and max(r.depth for r in nodes.values()) <= 6
    assert abs(sum(metrics.first().importances.values()) - 1) < 1e-9
    for cell in model.cells.limit(200).collect():
        said = []
        for tree in range(5):
            at = nodes[tree, 0]
            while at.feature >= 0:
                at = nodes[tree, at.left if cell[at.feature] <= at.bin else at.right]
            said.append(at.value)
        mean = sum(said) / 5
        assert abs(cell.mean - mean) < 1e-9 and abs(cell.std ** 2 - sum((x - mean) ** 2 for x in said) / 5) < 1e-9


def test_a_tree_splits_where_the_error_falls_most():
    import numpy as np
    from venuelens.operators.forest import grow
    bins = np.array([[0, 1, 2, 3], [0, 0, 0, 0], [0, 1, 0, 1]])
    w, y = np.array([1.0, 2.0, 1.0, 1.0]), np.array([1.0, 1.0, 4.0, 5.0])
    tree = {n[0]: n for n in grow(bins, w, w * y, [4, 1, 2], 30)}
    assert tree[0][2:4] == (0, 1)                                     # bins 0 and 1 of the first feature go left
    leaves = {tuple(n[8]): n[6] for n in tree.values() if n[2] < 0}
    assert leaves == {(0, 2, 0, 1, 0, 2): 1.0, (2, 3, 0, 1, 0, 2): 4.0, (3, 4, 0, 1, 0, 2): 5.0}


def test_changed_rows_or_arguments_train_anew(spark, tables, monkeypatch):
    from venuelens.session import scratch_path
    import pytest
    calls = []
    train = M.train_rating_model
    monkeypatch.setattr(M, "train_rating_model", lambda df, **kw: calls.append(kw) or train(df, **kw))
    path = scratch_path(spark, "test-model-key")
    lst = tables.listing().select("listing_id", "category", "area", "price", "rating")
    small = {"trees": 3, "max_depth": 4}
    _, metrics = M.load_or_train(lst, path, **small)
    M.load_or_train(lst.repartition(5), path, **small)          # the same rows in another order
    assert len(calls) == 1
    more = lst.union(M.filter_training_rows(lst).limit(1))
    _, again = M.load_or_train(more, path, **small)
    M.load_or_train(lst, path, trees=2, max_depth=4)
    assert len(calls) == 3 and again.first().n_samples == metrics.first().n_samples + 1
    with pytest.raises(ValueError):
        M.load_or_train(lst.limit(3), path, **small)            # an error is no reason to go on
