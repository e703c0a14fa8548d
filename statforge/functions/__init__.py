from statforge.functions import expr

__all__ = ["expr"]
