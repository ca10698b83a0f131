"""SQL for those queries of this subpackage that SQL can express."""

ORACLES: dict[str, str] = {
    "p6_found": "SELECT result_id FROM extraction_result WHERE length(text) > (SELECT capacity FROM size_spec WHERE spec_name = 'chunk')",
}
