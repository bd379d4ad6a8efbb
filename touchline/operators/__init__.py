"""DataFrame operators; each works on all matches or teams at once."""
