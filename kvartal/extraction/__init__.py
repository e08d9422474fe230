"""Pages to raw listings: one pass over the HTML, then column expressions."""
