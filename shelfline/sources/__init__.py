"""Reading, landing, generating and storing tables."""
