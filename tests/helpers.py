def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, repr(v))
    if hasattr(v, "isoformat"):
        return (1, v.replace(tzinfo=None).isoformat() if hasattr(v, "hour") else v.isoformat())
    if isinstance(v, (list, tuple)):
        return (1, repr([norm(x) for x in v]))
    return (1, repr(v))


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def rows(df):
    return [r.asDict() for r in df.collect()]
