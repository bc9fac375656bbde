"""Named analyses; importing the package registers them."""
