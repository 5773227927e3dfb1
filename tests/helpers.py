def canonical(rows):
    """Rows as comparable text, independent of order and of number types."""

    def value(x):
        if x is None or x != x:
            return "null"
        if isinstance(x, float):
            return f"{x:.6g}" if x != int(x) else str(int(x))
        return str(x)

    return sorted("\x1f".join(map(value, r)) for r in rows)
