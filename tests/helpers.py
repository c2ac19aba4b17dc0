import datetime

START = datetime.datetime(2024, 1, 1)


def entities(spark, features, labels, stamps=None):
    """Entity table from columns: `features` maps names to value lists, labels are -1 / 1."""
    n = len(labels)
    stamps = stamps or [START + datetime.timedelta(days=i) for i in range(n)]
    rows = [
        (i + 1, stamps[i], int(labels[i]), "fail" if labels[i] == 1 else "pass", *[
            None if v[i] is None else float(v[i]) for v in features.values()
        ])
        for i in range(n)
    ]
    schema = "entity_id long, test_timestamp timestamp, yield_label int, pass_fail string"
    schema += "".join(f", {name} double" for name in features)
    return spark.createDataFrame(rows, schema)


def daily(spark, days, per_day, fails, features=None, seed=0):
    """`days` x `per_day` entities, the first `fails` of each day fail."""
    import numpy as np

    random = np.random.default_rng(seed)
    n = days * per_day
    labels = [1 if i % per_day < fails else -1 for i in range(n)]
    stamps = [START + datetime.timedelta(days=i // per_day, minutes=i % per_day) for i in range(n)]
    features = features or {f"feature_{k:03d}": list(random.normal(size=n)) for k in range(1, 4)}
    return entities(spark, features, labels, stamps)


def scored(spark, y, risk):
    rows = [(i, int(a), None if b is None else float(b)) for i, (a, b) in enumerate(zip(y, risk))]
    return spark.createDataFrame(rows, "entity_id long, y_true int, risk double")
