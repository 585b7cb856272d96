"""Column builders: they stay inside Catalyst; the two Arrow functions say so."""
