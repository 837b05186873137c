"""Business rules as ordered tables of conditions and labels."""
