"""plans package."""
