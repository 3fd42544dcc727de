from collections import Counter


def bag(df):
    """Rows with multiplicity, columns in name order."""
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def column(df, name):
    return [r[0] for r in df.select(name).collect()]
