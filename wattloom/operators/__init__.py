"""DataFrame-to-DataFrame operators; each works on any table with the named columns."""
