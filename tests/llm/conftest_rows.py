def rows_of(frame, key, *columns):
    return {tuple(r[k] for k in key): tuple(r[c] for c in columns) for r in frame.select(*key, *columns).collect()}
