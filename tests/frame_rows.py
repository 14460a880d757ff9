"""Helpers of the tests (not a conftest: tests/llm has one of its own)."""


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally of some columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
