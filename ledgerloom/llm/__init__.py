"""Operators for preparing training data, with their queries; nothing outside imports this."""
