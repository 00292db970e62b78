"""Reading lines and files, writing lines, and versioned cell tables."""
