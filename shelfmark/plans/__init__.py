"""Work lists and reconciliation plans."""
