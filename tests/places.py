"""Places of the driver's tables (a name of its own: ``conftest`` is ambiguous beside tests/llm)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
