"""DataFrame-to-DataFrame operators; each works on batch input, the row-wise ones on streams too."""
