"""The driver's tables seen as expenses, registry, ledger and staging text."""
