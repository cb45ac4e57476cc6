"""The three ready feeds, composed from the operators."""
