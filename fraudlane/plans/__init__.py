"""End-to-end daily runs composed from the operators."""
