"""What the test modules share."""

SF_SMALL = "/root/testdata/sf0.001"


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, float) and v != v:
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, float) and v == int(v) and abs(v) < 1e15:
        return str(int(v))
    return str(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in records)
