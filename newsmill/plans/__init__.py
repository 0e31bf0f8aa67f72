"""newsmill.plans"""
