"""Column functions: text, URLs, HTML, page nodes, dates and salaries."""
