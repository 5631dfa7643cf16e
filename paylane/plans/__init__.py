"""The seven extracts, the control report and the freshness check, composed from the operators."""
