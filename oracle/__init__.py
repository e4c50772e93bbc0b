"""The registered queries as plain SQL, written independently of the operators."""
