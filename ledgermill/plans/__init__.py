"""Plans built from the operators: derived ledgers and reports."""
