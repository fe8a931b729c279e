"""Reading raw extracts and writing the stored layers."""
