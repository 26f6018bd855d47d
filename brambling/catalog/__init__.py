"""One module per group of queries; importing this package fills the registry."""
