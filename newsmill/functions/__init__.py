"""newsmill.functions"""
