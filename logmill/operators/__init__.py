"""DataFrame-to-DataFrame operators; each works on static and streaming input unless noted."""
