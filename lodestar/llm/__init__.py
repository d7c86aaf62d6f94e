"""Training-data operators and their queries; nothing else imports this package."""
